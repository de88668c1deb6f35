"""Substring dedup: winnowed anchors seed repeats, which are extended and cut from later documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natatio.llm.shared import skew_join, stored

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Words of an anchor.
ANCHOR = 10
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of each at least."""
    if len(_powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


class Spans:
    """Hashes of any span of a text's words, from sums over its prefixes."""

    def __init__(self, words: list[bytes]):
        hashes = np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64)
        up, self.down = _grown(len(words) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(words)])])

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x = (self.sums[high] - self.sums[low]) * self.down[low]
        x = (x ^ (x >> np.uint64(32))) * _MIX
        return x ^ (x >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def _segments(words: list[bytes], length: int) -> tuple[Spans, np.ndarray, np.ndarray, np.ndarray] | None:
    """Runs of windows with one anchor: spans, the anchors, first windows and numbers of windows."""
    windows = len(words) - length + 1
    if windows < 1:
        return None
    spans, at = Spans(words), np.arange(len(words) - ANCHOR + 1)
    anchor = _least(spans.of(at, at + ANCHOR), length - ANCHOR + 1)
    low = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    return spans, anchor[low], low, np.diff(np.append(low, windows))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.hash(text).alias("text_key"), text.cast("binary").alias("text"))


def _packed(rows: DataFrame) -> DataFrame:
    """The rows with their texts compressed, for the way through a shuffle."""

    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        small = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield batch.assign(text=[small.compress(x) for x in batch["text"]])

    return rows.mapInPandas(squeeze, rows.schema)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``(doc_id, text_key, starts)``: windows of ``length`` words that also start in a smaller id's document.

    Seed: a window's anchor is the least hash among its ``ANCHOR``-word spans (winnowing), so equal
    windows have equal anchors and neighbouring windows mostly share one. Such a run of windows is a
    segment: (anchor, first window, windows, hash of all its words). Anchors that occur in one document
    only are dropped; the others join documents. Segments with one anchor and one hash are
    folded to the smallest id, however many documents hold them.

    Extend: where an anchor has unlike segments, each kind is extended both ways from the anchor over all
    its windows, and the smallest id is found for each window. So no pairs of documents are made, the
    work is linear in the shared text, and every repeat of ``length`` words is found; runs of
    windows join to the maximal repeat.
    """
    rows = _rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def seeds(*wanted: str) -> DataFrame:
        def seed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for n, text in enumerate(batch["text"]):
                    if found := _segments(text.split(), length):
                        spans, anchor, low, count = found
                        out.append((np.full(len(low), n), anchor.view(np.int64), low, count, spans.of(low, low + count + length - 1).view(np.int64)))
                if out:
                    n, anchor, low, count, span = map(np.concatenate, zip(*out))
                    made = {"doc_id": batch["doc_id"].to_numpy()[n], "text_key": batch["text_key"].to_numpy()[n], "anchor": anchor, "low": low, "n": count, "span": span}
                    yield pd.DataFrame({k: made[k] for k in wanted})

        types = {"doc_id": kind, "text_key": "int", "anchor": "long", "low": "int", "n": "int", "span": "long"}
        return rows.mapInPandas(seed, ", ".join(f"{k} {types[k]}" for k in wanted))

    # A second pass over the texts is cheaper than keeping all segments, most of which aren't shared.
    joining = seeds("doc_id", "anchor").groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a < b").select("anchor", "n")
    joining = stored(joining, "joining")
    shared = stored(skew_join(seeds("doc_id", "text_key", "anchor", "low", "n", "span"), joining.select("anchor"), ["anchor"], joining), "segments")
    kinds = shared.where("doc_id is not null").groupBy("anchor", "span").agg(F.min(F.struct("doc_id", "text_key", "low", "n")).alias("first"), F.count("*").alias("held"))
    several = kinds.groupBy("anchor").count().where("count > 1").select("anchor", F.lit(True).alias("unlike"))
    kinds = stored(kinds.join(several, "anchor", "left").select("anchor", "span", "held", "first.*", F.coalesce("unlike", F.lit(False)).alias("unlike")), "kinds")
    texts = kinds.where("unlike").groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("anchor", "span", "low", "n")).alias("todo"))

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc_id, text, asked in zip(batch["doc_id"], batch["text"], batch["todo"]):
                spans = Spans(whole.decompress(text).split())
                low, n = (np.array([x[k] for x in asked], np.int64) for k in ("low", "n"))
                at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                anchor, span = (np.repeat([x[k] for x in asked], n) for k in ("anchor", "span"))
                yield pd.DataFrame({"anchor": anchor, "span": span, "j": at - np.repeat(low, n), "window": spans.of(at, at + length).view(np.int64), "doc_id": doc_id})

    extended = stored(_packed(rows).join(texts, ["doc_id", "text_key"]).select("doc_id", "text", "todo").mapInPandas(extend, f"anchor long, span long, j int, window long, doc_id {kind}"), "windows")
    earlier = stored(extended.groupBy("anchor", "window").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1"), "earlier")
    matched = skew_join(extended, earlier.select("anchor", "window", "least"), ["anchor", "window"], earlier.select("anchor", "window", "n")).where("least < doc_id")
    matched = matched.groupBy("anchor", "span").agg(F.map_from_entries(F.collect_set(F.struct("j", "least"))).alias("earlier"))
    told = stored(kinds.select("anchor", "span", F.col("doc_id").alias("first")).join(matched, ["anchor", "span"], "left"), "told")
    judged = skew_join(shared, told, ["anchor", "span"], kinds.select("anchor", "span", F.col("held").alias("n")))
    starts = F.expr("""case when earlier is null then if(first < doc_id, sequence(low, low + n - 1), array())
        else transform(filter(sequence(0, n - 1), j -> coalesce(try_element_at(earlier, j), first) < doc_id), j -> low + j) end""")
    return judged.select("doc_id", "text_key", starts.alias("starts")).where("size(starts) > 0").groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: each text without the repeats of earlier documents.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window of ``length`` words that covers it also
    starts in a document with a smaller id; windows are judged on the input. ``kept`` has the kept words
    joined by one space, as UTF-8.

    Null and empty texts have no words. A repeat within one document stays. Repeated rows (one id) are
    judged alike and don't cut each other. A null id is smaller than none and loses nothing. Other
    columns are ignored. An empty table gives an empty result.
    """
    rows = _rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = _packed(rows).join(repeats(docs, id_col, text_col, length), ["doc_id", "text_key"], "left").select("doc_id", "text", "starts")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = zstandard.ZstdDecompressor()
        for batch in batches:
            totals, gone, kept = [], [], []
            for text, starts in zip(batch["text"], batch["starts"]):
                words = whole.decompress(text).split()
                totals.append(len(words))
                if starts is not None and len(starts):
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, np.asarray(starts) + length, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    words = [w for w, s in zip(words, stay.tolist()) if s]
                gone.append(totals[-1] - len(words))
                kept.append(b" ".join(words))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": totals, "n_removed": gone, "kept": kept})

    return found.mapInPandas(cut, f"doc_id {kind}, n_words long, n_removed long, kept binary")


def kept_digests(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of ``remove_repeats``."""
    return remove_repeats(docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
