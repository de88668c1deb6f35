"""Benchmark decontamination: rare gapped n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from natatio.llm.shared import settled, word_blocks

#: A seed is two words of an item, this many places apart at most, and how likely it may be at a place of a text of independent words.
REACH, RARE = 3, 1e-7
#: Seeds that each item keeps at least, its rarest, however likely they are.
KEPT = 48
#: Unlike seeds of an item that a stretch of a text must have; one for an item of fewer than FEW words.
NEEDED, FEW = 2, 4
#: A document's passage is a match from this share of the item's own alignment score on.
THRESHOLD = 0.5
#: Alignment scores of equal words, of unlike words and of a word left out.
MATCH, UNLIKE, GAP = 2, -1, -1
#: Seeds up to this number are sent to every task (16 bytes each); beyond it, all n-grams are joined by shuffle.
SENT = 1 << 20
#: Items with up to so many seeds and words in all are sent to every task, which then judges its hits where it finds them; those of larger benchmarks are judged after a shuffle.
WHOLE = 1 << 20
#: Hits, once for each item, that are sorted at once, and bits of a seed's hash that a first look goes by.
SORTED, LOOK = 1 << 22, 22
#: Stretches of texts that are aligned together.
ALIGNED = 4096
#: Words that a task counts at once, and cells of alignment tables computed at once.
HELD, CELLS = 1 << 20, 1 << 20


def _words(data: bytes) -> list[bytes]:
    return [w for block in word_blocks(data.lower()) for w in block]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = ((a * np.uint64(0x9E3779B97F4A7C15)) ^ (a >> np.uint64(29)) ^ b) * np.uint64(0xD6E8FEB86659FD93)
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def _seeds(words: list[bytes], pairs: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds with the places of their words: all pairs of words up to ``REACH`` places apart, told by the two words alone; or single words."""
    h = np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64)
    if not pairs:
        return _mixed(h, np.zeros_like(h)), np.arange(len(h)), np.arange(len(h))
    parts = [(_mixed(h[:-gap], h[gap:]), np.arange(len(h) - gap), np.arange(gap, len(h))) for gap in range(1, min(REACH, len(h) - 1) + 1)]
    return tuple(map(np.concatenate, zip(*parts))) if parts else (np.empty(0, np.int64),) * 3


def _runs(places: np.ndarray, seeds: np.ndarray, size: int) -> list[tuple[int, int]]:
    """First and last places of stretches of a text that have enough unlike seeds of an item of ``size`` words close by each other."""
    order = np.argsort(places, kind="stable")
    places, seeds = places[order], seeds[order]
    cuts = np.flatnonzero(np.diff(places) > size + size // 2 + 1) + 1
    return [(int(p[0]), int(p[-1])) for p, s in zip(np.split(places, cuts), np.split(seeds, cuts)) if len(np.unique(s)) >= (NEEDED if size >= FEW else 1)]


class _Items:
    """Seeds and words of all items of a benchmark: ``seeds(seed, number)``, sorted by the seed, and items as numbers of words, by their number."""

    def __init__(self, known: dict[bytes, int], seeds: pd.DataFrame, items: list[np.ndarray]):
        self.known, self.items, self.sizes = known, items, np.array([len(x) for x in items], np.int64)
        self.hashes = np.array(list(map(xxhash.xxh64_intdigest, known)), np.uint64)
        self.seeds, first = np.unique(seeds["seed"].to_numpy(np.int64), return_index=True)
        self.first, self.owners = np.append(first, len(seeds)), seeds["number"].to_numpy(np.int64)
        self.pairs = sorted({bool(n > 1) for n in self.sizes})
        self.look = np.zeros(1 << LOOK, bool)
        self.look[self.seeds.view(np.uint64) >> np.uint64(64 - LOOK)] = True

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for those that no item has."""
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the seeds in a sequence of words."""
        places, found = [], []
        for gap in [g for pairs in self.pairs for g in (range(1, REACH + 1) if pairs else [0])]:
            one, two = words[: len(words) - gap], words[gap:]
            at = np.flatnonzero((one >= 0) & (two >= 0))
            seed = _mixed(self.hashes[one[at]], self.hashes[two[at]] if gap else np.zeros(len(at), np.uint64))
            some = np.flatnonzero(self.look[seed.view(np.uint64) >> np.uint64(64 - LOOK)])
            number = np.minimum(np.searchsorted(self.seeds, seed[some]), len(self.seeds) - 1)
            same = self.seeds[number] == seed[some]
            places.append(at[some[same]])
            found.append(number[same])
        return np.concatenate(places), np.concatenate(found)

    def runs(self, texts: np.ndarray, places: np.ndarray, found: np.ndarray) -> Iterator[np.ndarray]:
        """Rows of text, item, first and last place: the stretches of ``_runs``, of many texts and all items at once."""
        parts = int((self.first[found + 1] - self.first[found]).sum()) // SORTED + 1
        for part in range(parts):
            kept = self.owners % parts == part
            owners, first = self.owners[kept], np.append(0, np.cumsum(kept))[self.first]
            many = first[found + 1] - first[found]
            hit = np.repeat(np.arange(len(found)), many)
            if not len(hit):
                continue
            item = owners[np.repeat(first[found], many) + np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)]
            text, place, seed = texts[hit], places[hit], found[hit]
            order = np.lexsort((place, item, text))
            text, item, place, seed = text[order], item[order], place[order], seed[order]
            size = self.sizes[item]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(place) > (size + size // 2 + 1)[1:])
            run = np.cumsum(new) - 1
            order = np.lexsort((seed, run))
            unlike = np.ones(len(text), bool)
            unlike[1:] = (run[order][1:] != run[order][:-1]) | (seed[order][1:] != seed[order][:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(text)) - 1
            enough = np.bincount(run[order][unlike], minlength=len(begin)) >= np.where(size[begin] >= FEW, NEEDED, 1)
            yield np.stack([text[begin], item[begin], place[begin], place[last]], 1)[enough]


def _hashes(words: list[bytes]) -> bytes:
    return np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64).tobytes()


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Local alignment of pairs of word sequences: columns score, first word and end of the part of the passage.

    The tables of many pairs are filled together, one row of the item at a time; a run of words left out
    is carried along the row by a running maximum. Among equal scores, the earliest end wins.
    """
    out = np.zeros((len(items), 3), np.int64)
    order = sorted(range(len(items)), key=lambda k: (len(items[k]), len(passages[k])))
    at = 0
    while at < len(order):
        some = order[at : at + max(1, CELLS // max(1, len(items[order[-1]]) + max(len(passages[k]) for k in order[at : at + 2048])))][:2048]
        at += len(some)
        rows, cols = max(len(items[k]) for k in some), max(len(passages[k]) for k in some)
        if not rows or not cols:
            continue
        a, b = np.zeros((len(some), rows), np.int64), np.ones((len(some), cols), np.int64)
        real_a, real_b = np.zeros((len(some), rows), bool), np.zeros((len(some), cols), bool)
        for n, k in enumerate(some):
            a[n, : len(items[k])], real_a[n, : len(items[k])] = items[k], True
            b[n, : len(passages[k])], real_b[n, : len(passages[k])] = passages[k], True
        # Score and start are kept in one number, so that a maximum takes both along; later starts win.
        unit = np.int64(cols + 1)
        place = np.arange(cols, dtype=np.int64)
        above = np.broadcast_to(place + 1, (len(some), cols)).copy()
        best, end = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
        for i in range(rows):
            same = (b == a[:, i : i + 1]) & real_b & real_a[:, i : i + 1]
            step = np.where(same, MATCH, np.where(real_b & real_a[:, i : i + 1], UNLIKE, -(1 << 20)))
            before = np.concatenate([np.zeros((len(some), 1), np.int64), above[:, :-1]], 1)
            cell = np.maximum(np.maximum(before + step * unit, above + GAP * unit), place + 1)
            slope = -GAP * unit * place
            cell = np.maximum.accumulate(cell + slope, 1) - slope
            above = np.where(cell >= unit, cell, place + 1)
            score = np.where(real_b, above // unit, 0)
            top = score.argmax(1)
            value = above[np.arange(len(some)), top]
            better = score[np.arange(len(some)), top] > best // unit
            best, end = np.where(better, value, best), np.where(better, top + 1, end)
        out[some, 0], out[some, 1], out[some, 2] = best // unit, best % unit, end
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, text_key, item_id, score, first_word, end_word)``: documents with a copy of a benchmark item, exact or edited.

    A-Z is lower-cased; words are ``[^\\x20\\x09-\\x0D]+``. Seeds are pairs of an item's words that are rare: the product of
    their shares of all words (of the documents, counted over all of them, of the items' words only) is ``RARE`` at
    most; an item keeps its ``KEPT`` rarest seeds in any case. So a passage that leaked often stays rare by
    its words. The two words may be up to ``REACH`` places apart, in the item as in the text, so that words changed, put in or left out
    between them don't matter. A document that has ``NEEDED`` unlike seeds of an item close by each other is aligned with it: the stretch around each run of
    its seeds, half as long again as the item to either side, by Smith-Waterman. ``score`` is the best
    alignment's share of the item's score with itself; pairs from ``threshold`` on are returned, one
    row for each document and item. Items of one word match by it, those of fewer than ``FEW`` words by a pair.

    An edited copy at the threshold is missed if hardly any two rare words near each other are left in it; the tests measure a recall of over 0.9 at
    all rates of edits that keep the score at 0.5. A benchmark of up to ``WHOLE`` seeds and words is sent to every task, which aligns its documents as it finds seeds in them. Of larger ones, seeds
    alone are sent up to ``SENT`` and documents are aligned after a shuffle; beyond that, all pairs are joined with the seeds by a shuffle; with the same
    result. There is no cap on candidates. Null and empty texts match nothing, texts of any length are searched whole. Repeated rows are found
    each; ``text_key`` tells rows of one id apart. Null ids are kept. Other columns are ignored. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).cast("binary").alias("text"))
    doc_kind, item_kind = rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()

    def of_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item_id, data in zip(batch["item_id"], batch["text"]):
                words = _words(data)
                seeds, one, two = _seeds(words, len(words) > 1)
                if words:
                    gram = [[words[i], words[j]] if i < j else [words[i]] for i, j in zip(one.tolist(), two.tolist())]
                    yield pd.DataFrame({"item_id": item_id, "item": xxhash.xxh64_intdigest(b" ".join(words)) >> 1, "size": len(words), "seed": seeds, "gram": gram, "words": _hashes(words)})

    grams = settled(items.mapInPandas(of_items, f"item_id {item_kind}, item long, size int, seed long, gram array<binary>, words binary"))
    wanted = grams.select(F.explode("gram").alias("word")).distinct()
    few = wanted.limit(SENT + 1).count() <= SENT
    known = spark.sparkContext.broadcast({bytes(r["word"]): n for n, r in enumerate(wanted.toLocalIterator())} if few else None)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, total = Counter(), 0
        table = lambda: pd.DataFrame([*counts.items(), (None, total)], columns=["word", "n"])
        place = None if known.value is None else known.value.get
        sums = np.zeros(0 if known.value is None else len(known.value) + 1, np.int64)  # the last of all other words
        for batch in batches:
            for data in batch["text"]:
                for words in word_blocks(data.lower()):
                    total += len(words)
                    if place:
                        np.add.at(sums, np.fromiter(map(place, words, repeat(-1)), np.int64, len(words)), 1)
                    else:
                        counts.update(words)
            if len(counts) > HELD:
                yield table()
                counts, total = Counter(), 0
        counts.update({w: n for w, n in zip(known.value or (), sums.tolist()) if n})
        yield table()

    counts = settled(rows.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = (counts.where("word is null").first() or [None, 0])[1]
    shares = counts.where("word is not null").select("word", F.log10(F.col("n") / F.lit(max(1, total))).alias("share"))
    single = grams.select("item", "item_id", "size", "seed", "gram").distinct().select("item", "item_id", "size", "seed", F.explode("gram").alias("word")).join(shares, "word", "left")
    # A word that no document has is rarer than any.
    likely = single.groupBy("item", "item_id", "size", "seed").agg(F.sum(F.coalesce("share", F.lit(-30.0))).alias("chance"))
    rank = F.row_number().over(Window.partitionBy("item", "item_id").orderBy("chance", "seed"))
    seeds = settled(likely.withColumn("rank", rank).where((F.col("chance") <= float(np.log10(RARE))) | (F.col("rank") <= KEPT)).select("item", "item_id", "size", "seed"))
    number = seeds.select("seed").distinct().limit(SENT + 1).count()
    small = few and seeds.limit(WHOLE + 1).count() <= WHOLE and (grams.select("item_id", "item", "size").distinct().agg(F.sum("size")).first()[0] or 0) <= WHOLE
    if small and number <= SENT:
        return _judged(rows, grams, seeds, known, threshold)
    kinds = [r["pairs"] for r in grams.select((F.col("size") > 1).alias("pairs")).distinct().collect()]
    # With its item's number if no other has the seed and one seed isn't enough for it, else -1.
    own = seeds.groupBy("seed").agg(F.count("*").alias("n"), F.min("item").alias("item"), F.min("size").alias("size"))
    listed = own.select("seed", F.expr(f"if(n = 1 and size >= {FEW}, item, -1)").alias("item")).toPandas().sort_values("seed") if number <= SENT else None
    sent = spark.sparkContext.broadcast(None if listed is None else listed["seed"].to_numpy(np.int64))
    owner = spark.sparkContext.broadcast(None if listed is None else listed["item"].to_numpy(np.int64))

    def seek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = []
            for n, data in enumerate(batch["text"]):
                words = _words(data)
                for pairs in kinds:
                    found, first, _ = _seeds(words, pairs)
                    if sent.value is not None and len(found) and len(sent.value):
                        at = np.minimum(np.searchsorted(sent.value, found), len(sent.value) - 1)
                        place = np.flatnonzero(sent.value[at] == found)
                        # A lone seed of an item can't be a stretch; seeds of several items may be anyone's.
                        of, inverse, many = np.unique(owner.value[at[place]], return_inverse=True, return_counts=True)
                        place = place[(of == -1)[inverse] | (many[inverse] + many[of == -1].sum() >= NEEDED)]
                    else:
                        place = np.arange(len(found) if sent.value is None else 0)
                    if len(place):
                        hits.append((n, first[place], found[place]))
            if hits:
                n = np.repeat([h[0] for h in hits], [len(h[1]) for h in hits])
                yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[n], "text_key": batch["text_key"].to_numpy()[n], "place": np.concatenate([h[1] for h in hits]), "seed": np.concatenate([h[2] for h in hits])})

    hits = rows.mapInPandas(seek, f"doc_id {doc_kind}, text_key long, place int, seed long")
    pairs = hits.join(seeds, "seed").groupBy("doc_id", "text_key", "item_id", "item", "size").agg(F.collect_list(F.struct("place", "seed")).alias("hits")).where("size(hits) > 1 or size < %d" % FEW)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs = [_runs(np.array([h["place"] for h in hits]), np.array([h["seed"] for h in hits]), size) for hits, size in zip(batch["hits"], batch["size"])]
            yield batch.drop(columns=["hits", "size"]).assign(lows=[[a for a, _ in r] for r in runs], highs=[[b for _, b in r] for r in runs])

    pairs = pairs.mapInPandas(gather, f"doc_id {doc_kind}, text_key long, item_id {item_kind}, item long, lows array<int>, highs array<int>").where("size(lows) > 0")
    whole = grams.select(F.col("item_id").alias("i"), F.col("item").alias("k"), F.col("words").alias("item_words")).distinct()
    pairs = pairs.join(whole, F.expr("item <=> k and item_id <=> i"))
    asked = pairs.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("item_id", "lows", "highs", "item_words")).alias("asked"))
    joined = rows.withColumnRenamed("doc_id", "d").withColumnRenamed("text_key", "t").join(asked, F.expr("d <=> doc_id and t = text_key")).select("doc_id", "text_key", "text", "asked")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, queries, passages = [], [], []
            for n, (data, asked) in enumerate(zip(batch["text"], batch["asked"])):
                words = np.frombuffer(_hashes(_words(data)), np.int64)
                for m, one in enumerate(asked):
                    item = np.frombuffer(one["item_words"], np.int64)
                    reach = len(item) + len(item) // 2 + 1
                    for first, last in zip(one["lows"], one["highs"]):
                        low = max(0, int(first) - reach)
                        keys.append((n, m, low))
                        queries.append(item)
                        passages.append(words[low : int(last) + REACH + 1 + reach])
            if not keys:
                continue
            found = align(queries, passages)
            best: dict[tuple[int, int], tuple] = {}
            for (n, m, low), item, (value, first, end) in zip(keys, queries, found.tolist()):
                share = value / (MATCH * len(item))
                if share >= threshold and share > best.get((n, m), (0,))[0]:
                    best[n, m] = (share, low + first, low + end)
            if best:
                yield pd.DataFrame({"doc_id": [batch["doc_id"].iloc[n] for n, _ in best], "text_key": [batch["text_key"].iloc[n] for n, _ in best], "item_id": [batch["asked"].iloc[n][m]["item_id"] for n, m in best], "score": [v[0] for v in best.values()], "first_word": [v[1] for v in best.values()], "end_word": [v[2] for v in best.values()]})

    return joined.mapInPandas(score, f"doc_id {doc_kind}, text_key long, item_id {item_kind}, score double, first_word long, end_word long")


def _judged(rows: DataFrame, grams: DataFrame, seeds: DataFrame, known: Broadcast, threshold: float) -> DataFrame:
    """``find_leaks`` for a benchmark that each task has whole: seeds are looked up and their stretches aligned in one pass over the documents."""
    # Items of the same words are one, of several ids.
    listed = grams.groupBy("item").agg(F.min("words").alias("words")).collect()
    number = {r["item"]: n for n, r in enumerate(listed)}
    word = {xxhash.xxh64_intdigest(w): n for w, n in known.value.items()}
    items = [np.array([word[h] for h in np.frombuffer(r["words"], np.uint64).tolist()], np.int64) for r in listed]
    item_ids: list[list] = [[] for _ in listed]
    for r in grams.select("item", "item_id").distinct().collect():
        item_ids[number[r["item"]]].append(r["item_id"])
    owned = pd.DataFrame([(r["seed"], number[r["item"]]) for r in seeds.select("seed", "item").distinct().toLocalIterator()], columns=["seed", "number"], dtype=np.int64)
    sent = rows.sparkSession.sparkContext.broadcast((owned.sort_values(["seed", "number"], ignore_index=True), items, item_ids))
    kinds = rows.schema["doc_id"].dataType.simpleString(), grams.schema["item_id"].dataType.simpleString()

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owned, item_words, item_ids = sent.value
        if not len(owned):
            return
        bench = _Items(known.value, owned, item_words)

        def found(ids: list, keys: list, texts: list[np.ndarray]) -> pd.DataFrame:
            # Texts lie one after the other, REACH places apart, so that no seed is of two.
            apart = np.full(REACH, -1, np.int64)
            starts = np.cumsum([0, *(len(x) + REACH for x in texts)])
            places, seeds = bench.hits(np.concatenate([y for x in texts for y in (x, apart)]))
            of = np.searchsorted(starts, places, side="right") - 1
            best: dict[tuple[int, int], tuple] = {}
            for runs in bench.runs(of, places - starts[of], seeds):
                for at in range(0, len(runs), ALIGNED):
                    some = runs[at : at + ALIGNED].tolist()
                    items = [item_words[m] for _, m, _, _ in some]
                    reach = [len(item) + len(item) // 2 + 1 for item in items]
                    lows = [max(0, first - r) for (_, _, first, _), r in zip(some, reach)]
                    scores = align(items, [texts[n][low : last + REACH + 1 + r] for (n, _, _, last), low, r in zip(some, lows, reach)])
                    for (n, m, _, _), item, low, (value, first, end) in zip(some, items, lows, scores.tolist()):
                        share = value / (MATCH * len(item))
                        if share >= threshold and share > best.get((n, m), (0,))[0]:
                            best[n, m] = (share, low + first, low + end)
            made = [(ids[n], keys[n], item_id, *value) for (n, m), value in best.items() for item_id in item_ids[m]]
            return pd.DataFrame(made, columns=["doc_id", "text_key", "item_id", "score", "first_word", "end_word"])

        for batch in batches:
            ids, keys, texts, held = [], [], [], 0
            for n, (doc_id, key, data) in enumerate(zip(batch["doc_id"], batch["text_key"], batch["text"]), 1):
                ids.append(doc_id)
                keys.append(key)
                texts.append(bench.numbers(_words(data)))
                held += len(texts[-1])
                if held >= HELD or n == len(batch):
                    if len(out := found(ids, keys, texts)):
                        yield out
                    ids, keys, texts, held = [], [], [], 0

    return rows.mapInPandas(judge, f"doc_id {kinds[0]}, text_key long, item_id {kinds[1]}, score double, first_word long, end_word long")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows whose text holds no copy of a benchmark item; same columns."""
    text = options.get("text_col", "text")
    leaks = find_leaks(docs, benchmark, **options).select("text_key").distinct()
    keyed = docs.withColumn("_key", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return keyed.join(leaks.withColumnRenamed("text_key", "_key"), "_key", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
