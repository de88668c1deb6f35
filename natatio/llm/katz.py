"""Katz-backoff scores of documents from counts of word pairs in partitioned tables."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natatio.llm.shared import most_common, settled, word_blocks

#: Bits of the code of a frequent word; the codes below 2**HOT_BITS are sent to every task, so this bounds what is broadcast.
HOT_BITS = 17
HOT = 1 << HOT_BITS
#: Codes of the sentence's two marks; frequent words follow. Other words are coded by a hash with the highest bit set.
START, END, FIRST = 0, 1, 2
RARE = 1 << 63
#: Frequent words that are coded by rank.
_NAMED_LIMIT = HOT - FIRST
#: Words that a task names as frequent, and contexts so frequent that their pairs are dealt out one by one.
NAMED, SPREAD = 1 << 16, 1 << 10
#: Pairs of words with codes under this are dealt by document, and their counts are summed and sent to every task; so of any other pair there is one in
#: so many tokens at most.
DENSE = 256
#: Counts up to this are discounted.
CUT = 5
#: Tokens to a partition, and tokens and documents packed at once.
PART_TOKENS, PACK_TOKENS, DOC_BITS = 2_000_000, 2_000_000, 15


class Model(NamedTuple):
    """What every task needs: bounded by the frequent words."""

    tokens: int
    types: int
    unigram: np.ndarray  #: discount by count, 0 to CUT
    bigram: np.ndarray
    unknown: float  #: probability of a word that training doesn't have
    scale: float  #: of the discounted unigram probabilities
    counts: np.ndarray  #: of the frequent words
    alpha: np.ndarray | None = None  #: log10 of the backoff weight of frequent contexts
    total: np.ndarray | None = None  #: log10 of the denominator of frequent contexts
    dense: np.ndarray | None = None  #: counts of the pairs of the commonest words

    def p1(self, count: np.ndarray) -> np.ndarray:
        """Unigram probability of a word with this training count."""
        cut = self.unigram[np.minimum(count, CUT)]
        p = np.where(count > CUT, 1.0, cut) * count * (self.scale / max(1, self.tokens))
        return np.where(count > 0, p, self.unknown)


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discounts of counts 1 to CUT from the numbers ``n[r]`` of n-grams seen r times.

    Where these numbers give no discount between 0 and 1 (small or odd data), the count is reduced by
    ``n1 / (n1 + 2 n2)``, 0.9 at most, instead.
    """
    out = np.ones(CUT + 1)
    tail = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    less = min(0.9, n[1] / (n[1] + 2 * n[2])) if n[1] else 0.5
    for r in range(1, CUT + 1):
        katz = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else -1.0
        out[r] = katz if 0 < katz < 1 else (r - less) / r
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Codes(dict):
    """Codes of words: frequent ones by rank, others by hash."""

    def __missing__(self, word: bytes) -> int:
        return xxhash.xxh64_intdigest(word) | RARE


def _pack(flush: int, parts: int, docs: list, codes: list[np.ndarray]) -> Iterator[dict]:
    """Rows of one load of documents: its word pairs by partition, and its document table."""
    lengths = np.array([len(c) for c in codes])
    w = np.concatenate(codes)
    h = np.empty_like(w)
    h[1:] = w[:-1]
    begins = np.cumsum(lengths) - lengths
    h[begins] = START
    train = np.array([not d[1] for d in docs], np.uint16)
    mark = np.repeat((np.arange(len(docs), dtype=np.uint16) << 1) | train, lengths)
    rare_w, rare_h = w >= RARE, h >= RARE
    route = np.where(rare_w, w, np.where(rare_h | (h >= SPREAD), h, (h << np.uint64(HOT_BITS)) | w))
    own = np.repeat(np.arange(len(docs), dtype=np.uint64) | np.uint64(flush << DOC_BITS), lengths)
    route = np.where((h < DENSE) & (w < DENSE), own, route)
    part = (_mix(route) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.uint32)
    order = np.argsort(part, kind="stable")
    part, hot = part[order], ~(rare_w | rare_h)[order]
    h, w, mark = h[order], w[order], mark[order]
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    squeeze = zstandard.ZstdCompressor(level=3)
    for a, b in zip(cuts, np.append(cuts[1:], len(part))):
        is_hot = hot[a:b]
        pair = (h[a:b][is_hot] << np.uint64(HOT_BITS)) | w[a:b][is_hot]
        one, two = mark[a:b][is_hot], mark[a:b][~is_hot]
        blob = b"".join(x.tobytes() for x in (np.array([len(one), len(two)], "<u4"), pair.astype("<u4"), (pair >> np.uint64(32)).astype("u1"), np.diff(one, prepend=np.uint16(0)), h[a:b][~is_hot], w[a:b][~is_hot], np.diff(two, prepend=np.uint16(0))))
        yield {"part": int(part[a]), "flush": flush, "blob": squeeze.compress(blob), "ids": None, "held_out": None, "n": None}
    yield {"part": flush % parts, "flush": flush, "blob": None, "ids": [d[0] for d in docs], "held_out": [d[1] for d in docs], "n": lengths.tolist()}


class Load(NamedTuple):
    """The word pairs of one partition: pairs of frequent words by one code, others by two."""

    pair: np.ndarray
    key: np.ndarray
    train: np.ndarray
    h: np.ndarray
    w: np.ndarray
    other_key: np.ndarray
    other_train: np.ndarray


def _load(batches: Iterator[pd.DataFrame]) -> Load:
    got, open_ = [], zstandard.ZstdDecompressor()
    for batch in batches:
        for flush, blob in zip(batch["flush"], batch["blob"]):
            data = open_.decompress(blob)
            n, m = np.frombuffer(data, "<u4", 2).tolist()
            at, parts = 8, []
            for kind, count in (("<u4", n), ("u1", n), ("<u2", n), ("<u8", m), ("<u8", m), ("<u2", m)):
                parts.append(np.frombuffer(data, kind, count, at))
                at += parts[-1].nbytes
            low, high, one, h, w, two = parts
            one, two = np.cumsum(one, dtype=np.uint16), np.cumsum(two, dtype=np.uint16)
            base = np.int64(flush << DOC_BITS)
            got.append(Load(low.astype(np.int64) | high.astype(np.int64) << 32, base + (one >> 1), (one & 1).astype(bool), h, w, base + (two >> 1), (two & 1).astype(bool)))
    if not got:
        i, b, u = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.uint64)
        return Load(i, i, b, u, u, i, b)
    return Load(*map(np.concatenate, zip(*got)))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Numbers of the runs of equal rows of sorted keys."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


class Others(NamedTuple):
    """Pairs with a rare word, in order of (w, h), with their training counts."""

    h: np.ndarray
    w: np.ndarray
    key: np.ndarray
    train: np.ndarray
    count: np.ndarray  #: of the pair
    w_count: np.ndarray  #: of w, where rare
    first: np.ndarray  #: whether the row is the first of its pair


def _others(load: Load, counts: np.ndarray) -> Others:
    order = np.lexsort((load.h, load.w))
    h, w, key, train = load.h[order], load.w[order], load.other_key[order], load.other_train[order]
    pair, word = _runs(w, h), _runs(w)
    count = np.bincount(pair, train, minlength=1).astype(np.int64)[pair]
    own = np.bincount(word, train, minlength=1).astype(np.int64)[word]
    hot = w < RARE
    own[hot] = counts[w[hot].astype(np.int64)] if len(counts) else 0
    return Others(h, w, key, train, count, own, np.append(True, np.diff(pair) > 0)[: len(pair)])


def _dense(pair: np.ndarray) -> np.ndarray:
    """Numbers of pairs of the commonest words; -1 for others."""
    h, w = pair >> HOT_BITS, pair & (HOT - 1)
    return np.where((h < DENSE) & (w < DENSE), h * DENSE + w, -1)


def _statistics(load: Load) -> pd.DataFrame:
    """Counts of frequent words (kind 0), numbers of pairs (1) and of rare words (2) by count, rare words (3) and their tokens (4), counts of dense pairs (5)."""
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    known = load.pair[load.train]
    dense = _dense(known)
    _, c = np.unique(known[dense < 0], return_counts=True)
    sums = np.bincount(dense[dense >= 0], minlength=1)
    out.append((5, np.flatnonzero(sums), sums[np.flatnonzero(sums)]))
    o = _others(load, np.empty(0, np.int64))
    counts = np.concatenate([c, o.count[o.first]])
    by = np.bincount(np.minimum(counts, CUT + 2), minlength=CUT + 3)
    out.append((1, np.arange(1, CUT + 2), by[1 : CUT + 2]))
    hot = o.w < RARE
    words = np.bincount(np.concatenate([load.pair[load.train] & (HOT - 1), o.w[hot & o.train].astype(np.int64)]), minlength=HOT)
    out.append((0, np.flatnonzero(words), words[np.flatnonzero(words)]))
    rare, n = np.unique(o.w[~hot & o.train], return_counts=True)
    by = np.bincount(np.minimum(n, CUT + 2), minlength=CUT + 3)
    out += [(2, np.arange(1, CUT + 2), by[1 : CUT + 2]), (3, np.zeros(1, np.int64), np.array([len(rare)])), (4, np.zeros(1, np.int64), np.array([n.sum()]))]
    return pd.DataFrame({"kind": np.concatenate([np.full(len(i), k) for k, i, _ in out]), "id": np.concatenate([i for _, i, _ in out]), "n": np.concatenate([n for _, _, n in out])})


def _contexts(load: Load, model: Model, rare: bool) -> pd.DataFrame:
    """Per context: training tokens, discounted-away tokens, unigram probability of what follows it."""
    o = _others(load, model.counts)
    use = o.first & (o.count > 0) & ((o.h >= RARE) == rare)
    h, c, p = o.h[use].view(np.int64), o.count[use], model.p1(o.w_count[use])
    if not rare:
        pair, count = np.unique(load.pair[load.train], return_counts=True)
        own = _dense(pair) < 0
        pair, count = pair[own], count[own]
        h, c, p = np.append(h, pair >> HOT_BITS), np.append(c, count), np.append(p, model.p1(model.counts[pair & (HOT - 1)]))
    return _summed(h, c, p, model)


def _summed(h: np.ndarray, c: np.ndarray, p: np.ndarray, model: Model) -> pd.DataFrame:
    away = np.where(c <= CUT, c * (1 - model.bigram[np.minimum(c, CUT)]), 0.0)
    ids, own = np.unique(h, return_inverse=True)
    add = lambda x: np.bincount(own, x, minlength=len(ids))
    return pd.DataFrame({"h": ids, "c": add(c).astype(np.int64), "away": add(away), "p1": add(p)})


def _dense_contexts(model: Model) -> pd.DataFrame:
    """The same of the dense pairs, from their sums."""
    pair = np.flatnonzero(model.dense)
    return _summed(pair // DENSE, model.dense[pair], model.p1(model.counts[pair % DENSE]), model)


def _seen(model: Model, count: np.ndarray) -> np.ndarray:
    """log10 of the discounted count."""
    return np.log10(np.maximum(1, count) * np.where(count > CUT, 1.0, model.bigram[np.minimum(count, CUT)]))


def _scores(load: Load, model: Model) -> pd.DataFrame:
    """Per document, the part of its sums that this partition knows; one row for each load, as its answer.

    The denominator of a rare context is its count: it is taken off where that word is itself a token,
    as each word is the context of one token. ``_pending`` has what is then still to be put right.
    """
    pair, own = np.unique(load.pair, return_inverse=True)
    c = np.bincount(own, load.train, minlength=len(pair)).astype(np.int64)
    h, w, dense = pair >> HOT_BITS, pair & (HOT - 1), _dense(pair)
    c = np.where(dense >= 0, model.dense[dense], c)
    value = np.where(c > 0, _seen(model, c) - model.total[h], model.alpha[h] + np.log10(model.p1(model.counts[w])))[own]
    o = _others(load, model.counts)
    hot = o.h < RARE
    of = np.where(hot, o.h, 0).astype(np.int64)
    more = np.where(o.count > 0, _seen(model, o.count) - np.where(hot, model.total[of], 0), np.log10(model.p1(o.w_count)) + np.where(hot, model.alpha[of], 0))
    more -= np.where(o.w >= RARE, np.log10(np.maximum(1, o.w_count)), 0)
    w_count = np.append(model.counts[load.pair & (HOT - 1)], o.w_count)
    keys, at = np.unique(np.append(load.key, o.key), return_inverse=True)
    add = lambda x: np.bincount(at, x, minlength=len(keys))
    known = add(w_count > 0).astype("<u4")
    base = add(np.log10((w_count + 0.5) / (model.tokens + 0.5 * (model.types + 1))))
    score = add(np.append(value, more))
    cuts = np.flatnonzero(np.append(True, np.diff(keys >> DOC_BITS) != 0)[: len(keys)])
    squeeze, rows = zstandard.ZstdCompressor(level=3), []
    for a, b in zip(cuts, np.append(cuts[1:], len(keys))):
        places = (keys[a:b] & ((1 << DOC_BITS) - 1)).astype("<u2")
        parts = (np.array([b - a], "<u4"), np.diff(places, prepend=places.dtype.type(0)), known[a:b], base[a:b], score[a:b])
        rows.append((keys[a] >> DOC_BITS, squeeze.compress(b"".join(x.tobytes() for x in parts))))
    return pd.DataFrame(rows, columns=["flush", "blob"])


def _sum_up(rows: pd.DataFrame) -> pd.DataFrame:
    """The sums of the documents of one load, from the answers of all partitions."""
    sums, open_ = np.zeros((3, 1 << DOC_BITS)), zstandard.ZstdDecompressor()
    met = np.zeros(1 << DOC_BITS, bool)
    for blob in rows["blob"]:
        data = open_.decompress(blob)
        n, at = int(np.frombuffer(data, "<u4", 1)[0]), 4
        fields = []
        for kind in ("<u2", "<u4", "<f8", "<f8"):
            fields.append(np.frombuffer(data, kind, n, at))
            at += fields[-1].nbytes
        places = np.cumsum(fields[0], dtype=np.uint16)
        met[places] = True
        for k in range(3):
            sums[k, places] += fields[k + 1]
    places = np.flatnonzero(met)
    return pd.DataFrame({"key": (int(rows["flush"].iloc[0]) << DOC_BITS) + places, "known": sums[0, places].astype(np.int64), "base": sums[1, places], "score": sums[2, places]})


def _pending(load: Load, model: Model) -> pd.DataFrame:
    """Tokens whose rare context may have to be looked up: backed off, or seen more often than CUT."""
    o = _others(load, model.counts)
    use = (o.h >= RARE) & ((o.count == 0) | (o.count > CUT))
    return pd.DataFrame({"h": o.h[use].view(np.int64), "key": o.key[use], "seen": o.count[use] > 0})


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every document.

    A-Z is lower-cased; tokens are the words ``[^\\x20\\x09-\\x0D]+`` and one end. The model learns from
    documents whose ``crc32(id as text) mod folds`` isn't ``held``. ``base_score`` is the add-half unigram
    score. ``score`` is the log10 probability by a Katz model of word pairs, evaluated token by token:

    * the pair is known: ``d(c) c(h, w) / c(h)``, with Good-Turing discounts d for counts up to CUT;
    * else ``alpha(h) P1(w)``; alpha is what the pairs of h leave, over what their words leave of P1, so that
      the probabilities after h sum to 1. If nothing is left (all counts over CUT), h counts once more. After
      a context without training, alpha is 1;
    * P1 is discounted likewise; what it leaves goes to one unknown word (1 / (N + 1) if that is nothing).

    The word pairs of all documents lie in a table that is partitioned by pair, so that a pair's training
    count and its uses meet in one task: pairs with a rare word by that word, others by context, those
    of the commonest contexts one by one. Pairs of the ``DENSE`` commonest words lie with their documents, so that no pair fills a partition, and are counted over all
    partitions. A coding of common words, from every task's most frequent ones, keeps
    the table small; it has no effect on results. Rare words are told apart by 63 bits of XXH64. Counts, discounts
    and context sums are sums over all partitions; only those of the 2**HOT_BITS common words go to every task, and
    sums of rare contexts are joined to the tokens that need them.

    Null and empty texts are one end token; texts of any length are counted and scored whole. A document with a null id is learned from. Repeated rows are
    scored and counted each. With no training, everything is unknown, at probability 1. Other columns are ignored. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), fold.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, total = Counter(), 0
        table = lambda: pd.DataFrame([*counts.most_common(NAMED), (None, total)], columns=["word", "n"])
        for batch in batches:
            for text in batch["text"]:
                for words in word_blocks(text.lower()):
                    counts.update(words)
                    total += len(words)
                total += 1
            if len(counts) > 1_000_000:
                yield table()
                counts, total = Counter(), 0
        yield table()

    named = settled(rows.select("text").mapInPandas(name, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    tokens = (named.where("word is null").first() or [None, 0])[1]
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(tokens / PART_TOKENS))
    words = spark.sparkContext.broadcast([bytes(x) for x in most_common(named.where("word is not null"), _NAMED_LIMIT)["word"]])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        code = Codes((w, i) for i, w in enumerate(words.value, FIRST))
        flush, held_docs, codes, held_tokens = TaskContext.get().partitionId() << 20, [], [], 0
        for batch in batches:
            for doc_id, out, text in zip(batch["doc_id"], batch["held_out"], batch["text"]):
                own = [np.fromiter(map(code.__getitem__, block), np.uint64, len(block)) for block in word_blocks(text.lower())]
                codes.append(np.concatenate([*own, np.array([END], np.uint64)]))
                held_docs.append((doc_id, bool(out)))
                held_tokens += len(codes[-1])
                if held_tokens >= PACK_TOKENS or len(held_docs) >> DOC_BITS:
                    yield pd.DataFrame(_pack(flush, parts, held_docs, codes))
                    flush, held_docs, codes, held_tokens = flush + 1, [], [], 0
        if held_docs:
            yield pd.DataFrame(_pack(flush, parts, held_docs, codes))

    schema = f"part int, flush long, blob binary, ids array<{kind}>, held_out array<boolean>, n array<long>"
    table = settled(rows.mapInPandas(pack, schema).repartitionById(parts, F.col("part")))
    pairs = table.where("blob is not null").select("flush", "blob")

    def each(work, schema: str) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield work(_load(batches))

        return pairs.mapInPandas(run, schema)

    model = _model(each(_statistics, "kind int, id long, n long").groupBy("kind", "id").agg(F.sum("n").alias("n")).toPandas())
    sums = lambda rare: each(lambda load: _contexts(load, model, rare), "h long, c long, away double, p1 double").groupBy("h").agg(F.sum("c").alias("c"), F.sum("away").alias("away"), F.sum("p1").alias("p1"))
    common = pd.concat([sums(False).toPandas(), _dense_contexts(model)]).groupby("h", as_index=False).sum()
    alpha, total = np.zeros(HOT), np.zeros(HOT)
    bottom = common["c"] + (common["away"] == 0)
    total[common["h"]] = np.log10(bottom)
    alpha[common["h"]] = np.log10(np.where(common["away"] == 0, 1.0, common["away"]) / bottom / (1 - common["p1"]))
    whole = spark.sparkContext.broadcast(model._replace(alpha=alpha, total=total))

    answers = each(lambda load: _scores(load, whole.value), "flush long, blob binary")
    scored = answers.groupBy("flush").applyInPandas(_sum_up, "key long, known long, base double, score double")
    contexts = sums(True).select("h", F.expr("log10(c)").alias("c"), F.expr("log10(c + if(away = 0, 1, 0))").alias("total"), F.expr("log10(if(away = 0, 1, away) / (c + if(away = 0, 1, 0)) / (1 - p1))").alias("alpha"))
    put_right = each(lambda load: _pending(load, whole.value), "h long, key long, seen boolean").join(contexts, "h").select("key", F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"), F.expr("if(seen, c - total, c + alpha)").alias("score"))
    by_doc = scored.union(put_right).groupBy("key").agg(*(F.sum(c).alias(c) for c in ("known", "base", "score")))
    listed = table.where("blob is null").select("flush", F.posexplode(F.arrays_zip("ids", "held_out", "n")).alias("at", "doc"))
    listed = listed.select((F.col("flush") * (1 << DOC_BITS) + F.col("at")).alias("key"), F.col("doc.ids").alias("doc_id"), F.col("doc.held_out").alias("held_out"), F.col("doc.n").alias("n_tokens"))
    return listed.join(by_doc, "key").select("doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def _model(rows: pd.DataFrame) -> Model:
    """Discounts and unigram model from the summed statistics."""
    counts = np.zeros(HOT, np.int64)
    words = rows[rows["kind"] == 0]
    counts[words["id"]] = words["n"]
    known = {(int(k), int(i)): int(n) for k, i, n in rows[rows["kind"].between(1, 4)].itertuples(index=False)}
    hot = np.bincount(np.minimum(counts, CUT + 2), minlength=CUT + 3)
    tokens = int(counts.sum()) + known.get((4, 0), 0)
    types = int((counts > 0).sum()) + known.get((3, 0), 0)
    ones = [0, *(int(hot[r]) + known.get((2, r), 0) for r in range(1, CUT + 2))]
    unigram = discounts(ones)
    unknown = sum(ones[r] * r * (1 - unigram[r]) for r in range(1, CUT + 1)) / max(1, tokens)
    scale = 1.0
    if not unknown:
        unknown, scale = 1 / (tokens + 1), tokens / (tokens + 1)
    dense = np.zeros(DENSE * DENSE, np.int64)
    sums = rows[rows["kind"] == 5]
    dense[sums["id"]] = sums["n"]
    by = np.bincount(np.minimum(dense, CUT + 2), minlength=CUT + 3)
    pairs = [0, *(int(by[r]) + known.get((1, r), 0) for r in range(1, CUT + 2))]
    return Model(tokens, types, unigram, discounts(pairs), unknown, scale, counts, dense=dense)
