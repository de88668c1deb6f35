"""Token-id files in Simple-8b words: coding, writing and reading."""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed values of the format: ids to a word and bits to an id, by selector. Selector 15 escapes: the next word is one id of 64 bits.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
#: Ids to a block; a block starts with a word of its own, whose place is in the block offsets.
BLOCK = 4096
#: Words whose ids a task remembers, and bytes of text coded at once.
REMEMBER, AT_ONCE = 700_000, 1 << 21

_COUNT_OF = np.array([*COUNTS, 0, 1], np.int64)
_STEPS = bytes([*COUNTS, 0, 1]).ljust(256, b"\0")
_WIDTH_OF = np.array([*WIDTHS, 0, 0], np.uint64)


def _need(ids: np.ndarray) -> np.ndarray:
    """The selector with the narrowest ids that each id fits; their number for an escape."""
    bounds = np.array([(1 << w) - 1 for w in WIDTHS], np.uint64)
    if len(ids) > len(_NARROW) and ids.max() < len(_NARROW):
        return _NARROW[ids.astype(np.int64)]
    return np.searchsorted(bounds, ids).astype(np.uint8)


#: The same for ids of two bytes, as a table.
_NARROW = np.searchsorted(np.array([(1 << w) - 1 for w in WIDTHS]), np.arange(1 << 16)).astype(np.uint8)


def encode(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Simple-8b words of documents that lie one after the other in ``ids``.

    ``ends`` has the end of each document. Returns the words, the end of each document in them,
    and per document the offsets of its blocks from its first word. Each word takes as many ids
    as the selectors allow at its place; the choice is made for all places at once and the
    places in use are then followed from word to word.
    """
    ids = np.ascontiguousarray(ids, np.uint64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    blocks = [np.arange(s, e, BLOCK) for s, e in zip(starts, ends)]
    first = np.concatenate(blocks) if blocks else np.empty(0, np.int64)
    if not len(ids):
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64), [np.empty(0, np.int32)] * len(ends)
    lengths = np.diff(np.append(first, len(ids)))
    left = np.minimum(np.repeat(first + lengths, lengths) - np.arange(len(ids)), COUNTS[0]).astype(np.uint8)
    need = _need(ids)
    chosen = np.where(need == len(WIDTHS), ESCAPE, len(WIDTHS) - 1).astype(np.uint8)
    for selector in range(len(COUNTS) - 2, -1, -1):
        count, fits = COUNTS[selector], need <= selector
        if np.count_nonzero(fits) < count:
            break
        have = 1
        while have < count:
            step = min(have, count - have)
            fits[:-step] &= fits[step:]
            fits[len(fits) - step :] = False
            have += step
        fits &= left >= count
        np.copyto(chosen, selector, where=fits)
    counts, place, at = chosen.tobytes().translate(_STEPS), [], 0
    while at < len(counts):
        place.append(at)
        at += counts[at]
    place = np.array(place, np.int64)
    chosen = chosen[place]
    slot = np.cumsum(1 + (chosen == ESCAPE)) - (1 + (chosen == ESCAPE))
    words = np.zeros(int(slot[-1]) + 1 + int(chosen[-1] == ESCAPE), np.uint64)
    words[slot] = chosen.astype(np.uint64) << np.uint64(60)
    for selector, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        use = chosen == selector
        if use.any():
            base, to = place[use], slot[use]
            word = words[to]
            for k in range(count):
                word |= ids[base + k] << np.uint64(k * width)
            words[to] = word
    words[slot[chosen == ESCAPE] + 1] = ids[place[chosen == ESCAPE]]
    slot, place = np.append(slot, len(words)), np.append(place, len(ids))
    word_starts = slot[np.searchsorted(place, starts)]
    return words, slot[np.searchsorted(place, ends)], [(slot[np.searchsorted(place, b)] - s).astype(np.int32) for b, s in zip(blocks, word_starts)]


def decode(words: np.ndarray) -> np.ndarray:
    """The ids of Simple-8b words, all words at once."""
    words = np.ascontiguousarray(words, np.uint64)
    if not len(words):
        return np.empty(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    literal = np.zeros(len(words), bool)
    if (selector == ESCAPE).any():  # in a run of such selectors, markers and literals take turns
        index, marks = np.arange(len(words)), selector == ESCAPE
        begins = np.maximum.accumulate(np.where(marks & ~np.append(False, marks[:-1]), index, 0))
        literal[1:] = (marks & ((index - begins) % 2 == 0))[:-1]
    marker = (selector == ESCAPE) & ~literal
    counts = np.where(literal, 1, np.where(marker, 0, _COUNT_OF[selector]))
    word = np.repeat(np.arange(len(words)), counts)
    k = (np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    width = np.where(literal, 0, _WIDTH_OF[selector]).astype(np.uint64)[word]
    ids = (words[word] >> (k * width)) & ((np.uint64(1) << width) - np.uint64(1))
    whole = literal[word]
    ids[whole] = words[word[whole]]
    return ids


def decode_block(words: np.ndarray, offsets: np.ndarray, block: int) -> np.ndarray:
    """The ids of one block of a document, without the blocks before it."""
    return decode(words[offsets[block] : offsets[block + 1] if block + 1 < len(offsets) else len(words)])


#: Classes of Latin-1 characters: 0 for what is left as it is, then letters, digits, signs, the apostrophe. Small letters of capitals.
_CLASS = bytes(1 if c.isalpha() else 2 if c in "0123456789" else 4 if c == "'" else 3 if "!" <= c <= "~" else 0 for c in map(chr, range(256)))
_SMALL = bytes(ord(c.lower()) for c in map(chr, range(256)))
_LETTERS = bytes(c for c in range(256) if _CLASS[c] == 1)
#: Whether the tokenizer cuts between characters of two classes, by eight times the first one's and the second one's.
_CUT = bytearray(256)
for _a, _b in [(1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 3), (2, 4), (3, 1), (3, 2), (4, 2)]:
    _CUT[8 * _a + _b] = 1


def _latin(data: bytes) -> bytes | None:
    """A UTF-8 text in Latin-1, if its characters are all of that and it can't have the name of a special token."""
    if b"<|" in data:
        return None
    try:
        return data if data.isascii() else data.decode().encode("latin-1")
    except UnicodeEncodeError:
        return None


def _pieces(texts: list[bytes]) -> list[list[bytes]]:
    """The words of Latin-1 texts, cut where the tokenizer cuts them.

    The tokenizer composes, lower-cases, and parts letters, single digits and runs of signs. In Latin-1 nothing is composed, so texts
    of these characters are lower-cased and cut between them here, all at once: fewer different words, most of letters
    alone. A sign isn't cut from the letters after it if it is an apostrophe, as the tokenizer has pieces such as ``'s``.
    """
    whole = b"\n".join(texts)
    kind = np.frombuffer(whole.translate(_CLASS), np.uint8)
    pairs = (kind[:-1] << np.uint8(3)) | kind[1:]
    cuts = np.flatnonzero(np.frombuffer(pairs.tobytes().translate(bytes(_CUT)), bool)) + 1
    ends = np.cumsum([len(x) + 1 for x in texts])
    ends = (ends + np.searchsorted(cuts, ends)).tolist()
    whole = np.insert(np.frombuffer(whole.translate(_SMALL), np.uint8), cuts, 32).tobytes()
    return [whole[a:b].split() for a, b in zip([0, *ends], ends)]


def _byte_names() -> dict[int, str]:
    """How the tokenizer's model spells each Latin-1 character: a printable character for each of its UTF-8 bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in printable)}
    return {c: "".join(names[b] for b in chr(c).encode()) for c in range(256) if c != 10}


class _Latin(dict):
    """Ids of Latin-1 words, which are learned as they are asked for."""

    def __init__(self, tokenizer, older: dict[bytes, bytes]):
        super().__init__()
        self.tokenizer, self.model, self.names, self.older = tokenizer, tokenizer.model, _byte_names(), older

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.older.get(word)) is None:
            text = word.decode("latin-1")
            if word.translate(None, _LETTERS):
                ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
            else:
                ids = array("I", [token.id for token in self.model.tokenize(text if text.isascii() else text.translate(self.names))])
            if sys.byteorder == "big":
                ids.byteswap()
            ids = ids.tobytes()
        self[word] = ids
        return ids


class WordIds:
    """Ids of whole texts by the ids of their words.

    The tokenizer drops white space and never joins what white space parts, so a text's ids are those of
    its words one after the other; each distinct word is encoded once by the library and remembered. Words of Latin-1
    letters alone are one piece each, which goes to the library's model as it is; others go through the
    whole tokenizer. Words used of late are kept, in two generations.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        #: Words of late, and those before them; words of Latin-1 texts by themselves.
        self.latin = _Latin(self.tokenizer, {})
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def __call__(self, texts: list[bytes], end: bytes) -> list[bytes]:
        """Little-endian 32-bit ids of UTF-8 texts, and the end after each."""
        if len(self.latin) > REMEMBER:
            self.latin.older = {}
            self.latin = _Latin(self.tokenizer, self.latin)
        latin = [_latin(data) for data in texts]
        parted = iter(_pieces([data for data in latin if data is not None]))
        others = [data.split() for data, own in zip(texts, latin) if own is None]
        self._learn(set().union(*others))
        rest = iter(others)
        return [b"".join([*(map(self.known.__getitem__, next(rest)) if own is None else map(self.latin.__getitem__, next(parted))), end]) for own in latin]

    def _learn(self, words: set[bytes]) -> None:
        if len(self.known) > REMEMBER:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        fresh = words.difference(known)
        again = fresh.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        rest = list(fresh - again)
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            found = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            known.update((w, np.array(x.ids, "<u4").tobytes()) for w, x in zip(part, found))


#: What this worker has read, by definition; kept from task to task.
_LOADED: dict[str, WordIds] = {}


def write_token_ids(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every whole text, in ascending id order, as a Parquet folder of Simple-8b words.

    Rows are dealt by ranges of the id, so that a range is a shard, in order; a row has ``shard``,
    ``doc_id``, ``start`` (ids before it in its shard), ``n_tokens``, ``offsets`` (of its blocks) and
    ``words``. ``end_id`` follows each document. The tokenizer's definition, a file of fixed
    size, is sent to the executors, which need not have it.

    Null and empty texts have the end id alone. Null ids come first; repeated rows are all written.
    Texts of any length are coded whole. Other columns are ignored. An empty table gives an empty folder.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard, start, text = TaskContext.get().partitionId(), 0, definition.value
        to_ids = _LOADED.get(text) or _LOADED.setdefault(text, WordIds(text))
        for batch in batches:
            keys, texts, held = [], [], 0
            for n, (doc_id, data) in enumerate(zip(batch["doc_id"], batch["text"]), 1):
                keys.append(doc_id)
                texts.append(data)
                held += len(data)
                if held >= AT_ONCE or n == len(batch):
                    out, start = coded(keys, to_ids(texts, end), shard, start)
                    yield out
                    keys, texts, held = [], [], 0

    def coded(keys: list, parts: list[bytes], shard: int, start: int) -> tuple[pd.DataFrame, int]:
        sizes = np.array([len(x) // 4 for x in parts])
        words, ends, offsets = encode(np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes))
        packed = [words[a:b].astype("<u8").tobytes() for a, b in zip(np.append(0, ends[:-1]), ends)]
        return pd.DataFrame({"shard": shard, "doc_id": pd.array(keys, dtype=object), "start": start + np.cumsum(sizes) - sizes, "n_tokens": sizes, "offsets": offsets, "words": packed}), start + int(sizes.sum())

    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt.mapInPandas(code, f"shard int, doc_id {kind}, start long, n_tokens long, offsets array<int>, words binary").write.parquet(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a token-id folder, with ``start`` counted from the first document of all.

    The totals of the shards, a row for each, are summed in shard order and sent to every task, so that the ids aren't shuffled.
    """
    rows = spark.read.parquet(path)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    return rows.join(F.broadcast(before), "shard").withColumn("start", F.col("start") + F.col("before")).drop("before")


def token_digests(coded: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the decoded words of each document."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [decode(np.frombuffer(x, "<u8")) for x in batch["words"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "start": batch["start"], "n_tokens": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]})

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", "start", "words").mapInPandas(check, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
