"""Document quality by co-training: a classifier of words and one of page metadata teach each other."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natatio.llm.shared import most_common, settled, stored, word_blocks

#: Classes of a page; only the first is good.
GOOD, JUNK, TOXIC = range(3)
#: Labelled rows that are fitted on, at most; one in CALIBRATING of them only calibrates.
FIT_ROWS, CALIBRATING = 20_000, 5
#: Words of the content view, and in how many fitted texts a word must be.
VOCABULARY, LEAST = 1 << 16, 3
#: Rounds of exchange, how sure a label must be to be handed over, and its weight against a given one.
ROUNDS, SURE, WEIGHT = 3, 0.95, 0.5
#: Chi-square of the features that a view listens to (a quarter of the examples, if they are few).
TELLING = 15.0
#: Values of one metadata feature.
BINS = 64

_KIND = np.full(256, 1, np.uint8)  # letters of any script
_KIND[np.frombuffer(bytes(range(33, 127)), np.uint8)] = 4  # signs
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[[9, 11, 12, 13, 32]], _KIND[10] = 3, 2, 1, 0, 5


def layout(data: bytes, words: int, distinct: int) -> list[int]:
    """Binned layout of a page: lines, line length, shares of capitals, signs and digits, and of distinct words."""
    space, lower, upper, digits, signs, lines = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=6).tolist()
    size, log = max(1, len(data)), lambda x: min(BINS - 1, int(2 * np.log2(1 + x)))
    share = lambda x, whole: min(BINS - 1, int(40 * x / max(1, whole)))
    return [log(lines), log(size / (lines + 1)), share(upper, upper + lower), share(signs, size), share(digits, size), share(distinct, words), log(words)]


LAYOUT = 7


class View:
    """Naive Bayes over the features that a page has, for three classes, from weighted counts.

    Features that are spread over the classes as pages are (a chi-square under ``TELLING``) have no say; there are so
    many of them that their noise would drown the others.
    """

    def __init__(self, counts: np.ndarray, pages: np.ndarray):
        even = counts.sum(0) * (pages / max(1.0, pages.sum()))[:, None]
        tells = ((counts - even) ** 2 / np.maximum(even, 1e-9)).sum(0) >= min(TELLING, pages.sum() / 4)
        self.table = np.where(tells, np.log(counts + 0.5) - np.log(pages + 1.0)[:, None], 0.0)
        self.prior = np.log(pages + 1) - np.log(pages.sum() + 3)
        self.knots, self.values = np.array([-1.0, 1.0]), np.array([-1.0, 1.0])

    def classes(self, flat: np.ndarray, page: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(page, self.table[k][flat], minlength=n) + self.prior[k] for k in range(3)])

    def odds(self, flat: np.ndarray, page: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of a good page, and the likelier of the other classes."""
        s = self.classes(flat, page, n)
        return self.calibrated(s[GOOD] - np.logaddexp(s[JUNK], s[TOXIC])), np.where(s[JUNK] >= s[TOXIC], JUNK, TOXIC)

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.knots, self.values)

    def calibrate(self, raw: np.ndarray, good: np.ndarray) -> None:
        """From these rows: isotonic over bins of 50 rows at least, or a logistic curve if they are few."""
        order = np.argsort(raw, kind="stable")
        raw, good = raw[order], good[order]
        if len(raw) < 200:
            slope, shift = logistic(raw[:, None], good).tolist() if len(raw) else (1.0, 0.0)
            self.knots = np.linspace(-200, 200, 801)
            self.values = np.clip(slope * self.knots + shift, -6, 6)
            return
        blocks: list[list[float]] = []
        for x, y in zip(np.array_split(raw, min(100, len(raw) // 50)), np.array_split(good, min(100, len(raw) // 50))):
            blocks.append([x.mean(), y.sum(), len(x)])
            while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
                x, y, n = blocks.pop()
                m = blocks[-1][2]
                blocks[-1] = [(blocks[-1][0] * m + x * n) / (m + n), blocks[-1][1] + y, m + n]
        p = np.array([(y + 1) / (n + 2) for _, y, n in blocks])
        self.knots, self.values = np.array([b[0] for b in blocks]), np.log(p / (1 - p))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights (none negative) and bias of a lightly regularised logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    scale = np.maximum(1.0, np.abs(x).max(0, initial=1.0))
    x, w = x / scale, np.zeros(x.shape[1])
    use = np.ones(len(w), bool)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian[np.ix_(use, use)], (x.T @ (y - p) - 1e-2 * w)[use])
        w[use] += np.clip(step, -5, 5)
        worst = np.append(w[:-1] < 0, False) & use
        if worst.any():
            w[worst], use[worst] = 0, False
    return w / scale


def _flat(lists: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(x) for x in lists]
    return np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.empty(0, np.int64), np.repeat(np.arange(len(lists)), sizes)


def _label(quality: Column, toxic: Column) -> Column:
    """The class of a labelled document; null if neither label is there."""
    return F.when(toxic == 1, TOXIC).when(quality == 0, JUNK).when(quality == 1, GOOD)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", named: tuple[str, ...] = ("lang", "source"), rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, p_text, p_meta, score, keep)``: how likely each document is good, by either view and by both.

    ``labels(doc_id, quality, toxic)``: a page is good if its quality is 1 and it isn't toxic; several labels of one
    document count as its worst. The content view has the words of the text, their beginnings and ends, the metadata view the ``named`` columns and
    the layout. Both are naive Bayes with three classes (good, junk, toxic), so a fit is a distributed sum.

    ``FIT_ROWS`` labelled documents at most, those with the least hashes, are fitted on. One in ``CALIBRATING`` of them is set
    aside to calibrate each view (isotonic, by bins) in every round, and to weigh the views
    in the end. In each of ``rounds``, both views judge all other documents; those that one view is sure of (``SURE``, calibrated)
    become examples for the other view, at ``WEIGHT``. All documents are then scored.

    The content view knows the ``VOCABULARY`` commonest words of the fitted texts at most, those in ``LEAST`` of them or more.

    Null and empty texts have no words and are judged by what they have. Null metadata is a value of its own. Without labels of
    both kinds, nothing is learned and all scores are 0.5. Null ids are scored and never labelled. Repeated rows are
    scored alike. Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    kinds = labels.groupBy(F.col(id_col).alias("doc_id")).agg(_label(F.min("quality"), F.max("toxic")).alias("label")).where("label is not null and doc_id is not null")
    order = F.xxhash64("doc_id")
    fit = kinds.orderBy(order, "doc_id").limit(FIT_ROWS).withColumn("calibrates", F.pmod(order, F.lit(1009)) % CALIBRATING == 0)
    fit = stored(fit, "fit")
    meta = [F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(BINS)).cast("int") for c in named]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), F.array(*meta).alias("named"))

    def words_of(data: bytes) -> tuple[set[bytes], int, int]:
        """Distinct words with their beginnings and ends, how many words are distinct, and all words."""
        seen, n = set(), 0
        for block in word_blocks(data.lower()):
            seen.update(block)
            n += len(block)
        distinct = len(seen)
        return seen | {b"< " + w[:5] for w in seen} | {b"> " + w[-3:] for w in seen}, distinct, n

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = Counter(w for data in batch["text"] for w in words_of(data)[0])
            yield pd.DataFrame(counts.items(), columns=["word", "n"])

    fitted = rows.join(F.broadcast(fit.where("not calibrates").select("doc_id")), "doc_id").select("text")
    counts = fitted.mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
    words = [bytes(x) for x in most_common(settled(counts), VOCABULARY)["word"]]
    shared = spark.sparkContext.broadcast(words)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {w: n for n, w in enumerate(shared.value)}
        for batch in batches:
            content, pages = [], []
            for data, names in zip(batch["text"], batch["named"]):
                seen, distinct, n = words_of(data)
                content.append(sorted(place[w] for w in seen if w in place))
                values = [*names, *layout(data, n, distinct)]
                pages.append([k * BINS + v for k, v in enumerate(values)])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "content": content, "page": pages})

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = stored(rows.mapInPandas(features, f"doc_id {kind}, content array<int>, page array<int>"), "features")
    told = made.join(F.broadcast(fit), "doc_id", "left")
    sizes = {"content": max(1, len(words)), "page": (len(named) + LAYOUT) * BINS}

    def summed(rows: DataFrame, examples) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Counts by view, class and feature (pages at -1) of ``examples(batch)``: a class for each row and view, -1 for none."""

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = {view: np.zeros((3, n + 1), np.int64) for view, n in sizes.items()}
            for batch in batches:
                given = examples(batch)
                for view, n in sizes.items():
                    flat, page = _flat(batch[view])
                    for k in range(3):
                        sums[view][k, :n] += np.bincount(flat[given[view][page] == k], minlength=n)
                        sums[view][k, n] += (given[view] == k).sum()
            for view, table in sums.items():
                k, i = np.nonzero(table)
                yield pd.DataFrame({"view": view, "k": k, "i": i, "n": table[k, i]})

        out = {view: np.zeros((3, n + 1)) for view, n in sizes.items()}
        for view, part in rows.mapInPandas(add, "view string, k int, i int, n long").groupBy("view", "k", "i").agg(F.sum("n").alias("n")).toPandas().groupby("view"):
            out[view][part["k"], part["i"]] = part["n"]
        return {view: (table[:, :-1], table[:, -1]) for view, table in out.items()}

    given = summed(told.where("not calibrates"), lambda batch: dict.fromkeys(sizes, batch["label"].to_numpy(np.int64)))
    if not given["page"][1][GOOD] or not given["page"][1][1:].sum():
        half = F.lit(0.5)
        return made.select("doc_id", half.alias("p_text"), half.alias("p_meta"), half.alias("score"), F.lit(True).alias("keep"))

    def raw(views: dict[str, View], batch: pd.DataFrame) -> dict[str, np.ndarray]:
        s = {name: view.classes(*_flat(batch[name]), len(batch)) for name, view in views.items()}
        return {name: x[GOOD] - np.logaddexp(x[JUNK], x[TOXIC]) for name, x in s.items()}

    def judge(views: dict[str, View], batch: pd.DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        return {name: view.odds(*_flat(batch[name]), len(batch)) for name, view in views.items()}

    aside = told.where("calibrates").select("content", "page", "label")

    def calibrated(views: dict[str, View]) -> tuple[np.ndarray, np.ndarray]:
        """Calibrate the views; the log odds of the rows set aside, and whether they are good."""
        sent = spark.sparkContext.broadcast(views)

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame({**raw(sent.value, batch), "label": batch["label"]})

        seen = aside.mapInPandas(look, "content double, page double, label int").orderBy("content", "page", "label").toPandas()
        good, out = (seen["label"] == GOOD).to_numpy(np.float64), []
        for name, view in views.items():
            view.calibrate(seen[name].to_numpy(), good)
            out.append(view.calibrated(seen[name].to_numpy()))
        return np.stack(out, 1), good

    views = {view: View(*table) for view, table in given.items()}
    calibrated(views)
    other = {"content": "page", "page": "content"}
    limit = float(np.log(SURE / (1 - SURE)))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(views)

        def exchange(batch: pd.DataFrame, sent=sent) -> dict[str, np.ndarray]:
            found = judge(sent.value, batch)
            return {view: np.where(found[other[view]][0] >= limit, GOOD, np.where(found[other[view]][0] <= -limit, found[other[view]][1], -1)) for view in sizes}

        pseudo = summed(told.where("label is null"), exchange)
        views = {view: View(*(g + WEIGHT * p for g, p in zip(given[view], pseudo[view]))) for view in sizes}
        odds, good = calibrated(views)
    if not rounds:
        odds, good = calibrated(views)
    weights = logistic(odds, good) if len(good) else np.array([0.5, 0.5, 0.0])
    final = spark.sparkContext.broadcast((views, weights))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        views, weights = final.value
        p = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        for batch in batches:
            found = judge(views, batch)
            both = np.stack([found[v][0] for v in views], 1) @ weights[:-1] + weights[-1]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "p_text": p(found["content"][0]), "p_meta": p(found["page"][0]), "score": p(both), "keep": both >= 0})

    return made.mapInPandas(score, f"doc_id {kind}, p_text double, p_meta double, score double, keep boolean")
