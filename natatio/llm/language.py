"""Language identification in two steps: the family, then one-versus-one machines within it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natatio.llm.linear import features, ngram_counts, train_svm

#: Families of common languages. Others are a family of their own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "pl", "cs", "sk", "uk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
    "semitic": ("ar", "he"),
    "indic": ("hi", "bn", "ur", "mr", "ne"),
}
UNKNOWN = "und"
#: Distinct texts of a language that the machines learn from, rows of one machine, and languages: at most.
PER_LANGUAGE, PER_MACHINE, LANGUAGES = 600, 4096, 256
_LETTER = re.compile(rb"[A-Za-z]")


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


def has_letters(data: bytes) -> bool:
    return bool(_LETTER.search(data)) or (not data.isascii() and any(map(str.isalpha, data.decode())))


class Judge:
    """The learned machines, as weights by task: ``family`` against the rest, and pairs of languages of one family."""

    def __init__(self, languages: list[str], weights: dict[tuple[str, str], np.ndarray]):
        self.languages, self.weights = sorted(languages), weights
        self.families = sorted({family_of(x) for x in languages})

    def __call__(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores of rows of features."""
        margin = lambda task: x @ self.weights[task][:-1] + self.weights[task][-1]
        sure = lambda m: 1 / (1 + np.exp(-3.0 * np.clip(m, -20, 20)))
        family, score = np.zeros(len(x), int), np.ones(len(x))
        if len(self.families) > 1:
            each = np.stack([margin(("family", f)) for f in self.families], 1)
            family, score = each.argmax(1), sure(each.max(1))
        out = np.empty(len(x), object)
        for k, name in enumerate(self.families):
            members, rows = [g for g in self.languages if family_of(g) == name], np.flatnonzero(family == k)
            votes = np.zeros((len(rows), len(members)))
            weakest = np.full((len(rows), len(members)), np.inf)
            for a, b in combinations(range(len(members)), 2):
                m = margin((members[a], members[b]))[rows]
                votes[:, a] += (m > 0) + 1e-3 * np.tanh(m)
                votes[:, b] += (m <= 0) - 1e-3 * np.tanh(m)
                weakest[:, a], weakest[:, b] = np.minimum(weakest[:, a], m), np.minimum(weakest[:, b], -m)
            best = votes.argmax(1)
            out[rows] = np.array(members, object)[best]
            if len(members) > 1:
                score[rows] *= sure(weakest[np.arange(len(rows)), best])
        return out.tolist(), score


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Judge:
    """Learn from the texts and languages of these rows; null languages and texts without letters teach nothing.

    A bounded sample is learned from: ``PER_LANGUAGE`` distinct texts of each language that has any with letters,
    those with the least hashes; repeats are folded before texts are counted or drawn. Each machine is trained in a task of its own, on about
    ``PER_MACHINE`` rows; only weights come to the driver. More than ``LANGUAGES`` languages are an error.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("pick"))
    found = rows.select("lang", "pick").distinct().groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages")
    counts = {r["lang"]: r["n"] for r in found}
    if not counts:
        return Judge([], {})
    likely = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 4 * PER_LANGUAGE / n))))
    rows = rows.where((F.col("pick") / 2.0**64 + 0.5) <= F.try_element_at(likely, "lang")).dropDuplicates(["lang", "pick"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("pick"))
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= PER_LANGUAGE)

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "rank": batch["rank"], "x": [features(ngram_counts(x)).tobytes() for x in batch["text"]]})

    ready = rows.select("lang", "rank", "text").mapInPandas(prepare, "lang string, rank int, x binary")
    families = sorted({family_of(x) for x in counts})
    share = max(1, PER_MACHINE // len(counts))
    tasks: dict[str, list[tuple[str, str, int, int]]] = {}
    for lang in counts:
        own = family_of(lang)
        tasks[lang] = [("family", f, 1 if f == own else -1, share) for f in families if len(families) > 1]
        tasks[lang] += [(min(lang, b), max(lang, b), 1 if lang < b else -1, PER_LANGUAGE) for b in counts if b != lang and family_of(b) == own]
    plan = docs.sparkSession.createDataFrame([(lang, *t) for lang, own in tasks.items() for t in own], "lang string, a string, b string, y int, most int")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "rank"])
        x, y = np.stack([np.frombuffer(v, np.float32) for v in rows["x"]]), rows["y"].to_numpy()
        return pd.DataFrame({"a": rows["a"].iloc[:1], "b": rows["b"].iloc[:1], "w": [train_svm(x, y).tobytes()]})

    made = ready.join(F.broadcast(plan), "lang").where("rank <= most").groupBy("a", "b").applyInPandas(learn, "a string, b string, w binary").collect()
    return Judge(list(counts), {(r["a"], r["b"]): np.frombuffer(r["w"], np.float32) for r in made})


def identify(docs: DataFrame, judge: Judge, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``lang_family`` and ``lang_score`` (0 to 1), from whole texts of any length alone.

    Null texts, texts without letters, and every text if nothing was learned, are ``und``, at score 0. Columns of these names
    are replaced; others stay. Repeated rows are judged alike.
    """
    known = docs.drop("lang_pred", "lang_family", "lang_score")
    shared = docs.sparkSession.sparkContext.broadcast(judge)

    @F.pandas_udf("lang_pred string, lang_score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            langs, scores = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            usable = [n for n, t in enumerate(batch) if t is not None and shared.value.languages and has_letters(t)]
            for at in range(0, len(usable), 512):
                rows = usable[at : at + 512]
                langs[rows], scores[rows] = shared.value(features(np.stack([ngram_counts(batch.iloc[n]) for n in rows])))
            yield pd.DataFrame({"lang_pred": langs, "lang_score": scores})

    family = F.create_map(*(F.lit(x) for lang in [*judge.languages, UNKNOWN] for x in (lang, family_of(lang))))
    found = known.withColumn("_found", predict(F.col(text_col).cast("binary")))
    return found.select(*(F.col(f"`{c}`") for c in known.columns), F.col("_found.lang_pred"), F.element_at(family, F.col("_found.lang_pred")).alias("lang_family"), F.col("_found.lang_score"))


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def language_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held: int = 2) -> DataFrame:
    """The rows of ``identify`` for all documents, learned from those whose id isn't in the held-out fold, and ``held_out``.

    A row with a null id is learned from. An empty table gives an empty result.
    """
    docs = docs.withColumn("held_out", F.coalesce(fold(id_col, folds) == held, F.lit(False)))
    return identify(docs, train(docs.where("not held_out"), text_col, lang_col), text_col)
