"""Ids of sentence pieces by a score-ordered agenda of merges, and texts from ids."""

from __future__ import annotations

import codecs
import heapq
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the format: the sign that stands for a space, and what stands for a byte that is no text.
SPACE, LOST = "▁", "�"
#: Distinct stretches of text whose ids a task remembers, in each of two generations, and characters of text coded at once.
REMEMBER, AT_ONCE = 400_000, 1 << 21
#: Characters up to which stretches have their agendas in the rows of one table, and the rank of a pair that is no piece.
SHORT, NEVER = 48, 1 << 30
#: Of so many distinct stretches one is compared with the library's ids.
CHECKED = 1


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return LOST, error.start + 1


codecs.register_error("natatio-byte-by-byte", _one_by_one)


class Pieces:
    """A merge-type vocabulary: pieces with scores, read from a model by the library, which also checks what is coded here.

    A text is escaped (a sign for each space, one before the text) and each of its characters is a symbol. Two neighbours may merge if together they are a
    piece; an agenda holds such pairs, the highest score first and the leftmost of equal ones. When the agenda
    is empty, symbols that are no piece are spelt as bytes. Unused pieces serve as steps of merges and are taken apart again at the end.

    Words with the spaces before them (and line ends) are stretches that no piece reaches over, if the vocabulary has none that would. Each distinct one is
    coded once and remembered for as long as it is in use. The agendas of many short stretches are rows of one table (``_merged_many``); that of a long or odd one is a heap, in which a
    popped pair is stale if a part of it has merged since (``_merged``).
    """

    def __init__(self, model: bytes, check: int = CHECKED):
        from sentencepiece import SentencePieceProcessor

        self.library, self.check = SentencePieceProcessor(model_proto=model), check
        lib, n = self.library, self.library.get_piece_size()
        probe = "  A  b　Ａ\n "
        if lib.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models that leave texts as they are, with a space put before them, are known here")
        names = [lib.id_to_piece(i) for i in range(n)]
        own = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.id_of, self.score_of = {names[i]: i for i in own}, {names[i]: lib.get_score(i) for i in own}
        self.unused = {names[i] for i in own if lib.is_unused(i)}
        self.byte_ids = {int(names[i][1:-1], 16): i for i in range(n) if lib.is_byte(i)}
        self.unknown = lib.unk_id()
        self.pairs = {p[k : k + 2] for p in self.id_of for k in range(len(p) - 1)}
        #: What an id adds to a text, in bytes; ids of control pieces add nothing, and that of the unknown piece its sign.
        self.bytes_of = [b"" if lib.is_control(i) else bytes([int(names[i][1:-1], 16)]) if lib.is_byte(i) else b" \xe2\x81\x87 " if lib.is_unknown(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.opens = [not (lib.is_control(i) or lib.is_byte(i) or lib.is_unknown(i)) and names[i].startswith(SPACE) for i in range(n)]
        self.control = {i for i in range(n) if lib.is_control(i)}
        parted = not any(x != SPACE and y == SPACE for x, y in self.pairs)
        alone = not any("\n" in p for p in self.pairs)
        self.coarse = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+") if parted else None
        self.newline = self._merged("\n") if alone else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # For tables of agendas: numbers of symbols (pieces have their ids, other characters of pieces numbers of their own), and for pairs of these that make a piece its rank
        # by score and its number.
        number = self.id_of | {c: n + k for k, c in enumerate(sorted(set("".join(self.id_of)) - self.id_of.keys()))}
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c, i in number.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        rank = {score: k for k, score in enumerate(sorted(set(self.score_of.values()), reverse=True))}
        made = sorted((number[p[:k]] << 32 | number[p[k:]], rank[self.score_of[p]], i) for p, i in self.id_of.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        self.pair_keys, self.pair_ranks, self.pair_symbols = (np.array(x, np.int64) for x in zip(*made)) if made else (np.full(1, -1, np.int64),) * 3

    def _merged(self, text: str) -> list[int]:
        """Ids of a stretch of escaped text by the agenda."""
        symbol: list[str | None] = list(text)
        n, before, after = len(symbol), list(range(-1, len(symbol) - 1)), [*range(1, len(symbol)), -1]
        agenda: list[tuple[float, int, int, int]] = []
        score, made = self.score_of, {}

        def consider(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                both = symbol[left] + symbol[right]
                if both in score:
                    heapq.heappush(agenda, (-score[both], left, right, len(both)))
                    if both in self.unused:
                        made[both] = (symbol[left], symbol[right])

        for k in range(n - 1):
            consider(k, k + 1)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            if symbol[left] is None or symbol[right] is None or len(symbol[left]) + len(symbol[right]) != size:
                continue
            symbol[left] += symbol[right]
            symbol[right] = None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            consider(before[left], left)
            consider(left, after[left])
        whole, parts = [], [x for x in reversed(symbol) if x is not None]
        while parts:
            part = parts.pop()
            if part in self.unused and part in made:
                parts += made[part][::-1]
            else:
                whole.append(part)
        return self._spelt(whole)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and number of what pairs of symbols make."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        there = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(there, self.pair_ranks[at], NEVER), np.where(there, self.pair_symbols[at], -1)

    def _merged_many(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of stretches of one length, filled up with -2, and how many they are.

        A row's agenda has the rank of each pair of its neighbours, in order. In a step each row merges its best pair, the leftmost of equal ones: the row closes up, and the two pairs
        beside the new symbol are looked up. Rows without a pair are done.
        """
        n, length = len(stretches), len(stretches[0])
        symbols = self.symbol_of[np.frombuffer("".join(stretches).encode("utf-32-le"), "<u4").reshape(n, length)]
        out, sizes = np.full((n, length), -2, np.int32), np.full(n, length)
        ranks, makes = self._pair(symbols[:, :-1], symbols[:, 1:])
        rows, left = np.arange(n), length
        while True:
            best = ranks.argmin(1) if left > 1 else np.zeros(len(rows), np.int64)
            each = np.arange(len(rows))
            done = ranks[each, best] == NEVER if left > 1 else np.ones(len(rows), bool)
            if done.any():
                out[rows[done], :left], sizes[rows[done]] = symbols[done], left
                rows, symbols, ranks, makes, best = rows[~done], symbols[~done], ranks[~done], makes[~done], best[~done]
                each = np.arange(len(rows))
                if not len(rows):
                    return out, sizes
            symbols[each, best] = makes[each, best]
            left -= 1
            places = np.arange(left)
            symbols = np.take_along_axis(symbols, places + (places > best[:, None]), 1)
            places = np.arange(left - 1)
            closed = places + (places >= best[:, None])
            ranks, makes = np.take_along_axis(ranks, closed, 1), np.take_along_axis(makes, closed, 1)
            for side in (-1, 0):
                some = np.flatnonzero((best + side >= 0) & (best + side < left - 1))
                at = best[some] + side
                ranks[some, at], makes[some, at] = self._pair(symbols[some, at], symbols[some, at + 1])

    def _spelt(self, symbols: list[str]) -> list[int]:
        """Ids of symbols; bytes for those that are no piece."""
        out: list[int] = []
        for symbol in symbols:
            found = self.id_of.get(symbol)
            if found is not None:
                out.append(found)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in symbol.encode()]
            else:
                out.append(self.unknown)
        return out

    def _stretches(self, text: str) -> list[str]:
        """The text cut wherever no piece can reach over."""
        pairs = self.pairs
        cuts = [k for k, both in enumerate(map(str.__add__, text, text[1:]), 1) if both not in pairs]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])] if cuts else [text]

    def _by_heap(self, stretch: str) -> bytes:
        return array("i", [i for part in self._stretches(stretch) for i in self._merged(part)]).tobytes()

    def _learn(self, stretches: set[str]) -> None:
        """Code the stretches that aren't known yet."""
        if len(self.known) > REMEMBER:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        fresh = stretches.difference(known)
        again = fresh.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        fresh -= again
        by_length: dict[int, list[str]] = {}
        for s in fresh:
            by_length.setdefault(len(s), []).append(s)
        for length, some in by_length.items():
            if length > SHORT or self.unused:
                known.update((s, self._by_heap(s)) for s in some)
                continue
            for at in range(0, len(some), 1 << 15):
                part = some[at : at + (1 << 15)]
                symbols, sizes = self._merged_many(part)
                odd = (symbols == -1).any(1) | (symbols >= len(self.bytes_of)).any(1)
                data, ends = symbols[symbols != -2].astype("<i4").tobytes(), (4 * np.cumsum(sizes)).tolist()
                known.update(zip(part, map(data.__getitem__, map(slice, [0, *ends], ends))))
                known.update((part[k], self._by_heap(part[k])) for k in np.flatnonzero(odd))
        if self.check:
            self._compare([(s, np.frombuffer(known[s], "<i4").tolist()) for s in fresh if zlib.crc32(s.encode()) % self.check == 0])

    def _compare(self, coded: list[tuple[str, list[int]]]) -> None:
        """The library's ids of these stretches must be the same. Where line ends stand alone, one call takes many stretches, one to a line."""
        if self.newline is None:
            for s, own in coded:
                if s.startswith(SPACE) and self.library.encode(s[1:].replace(SPACE, " ")) != own:
                    raise AssertionError(f"the library codes {s!r} otherwise")
            return
        pairs = [(s, own) for s, own in coded if "\n" not in s]
        for at in range(0, len(pairs), 4096):
            part = pairs[at : at + 4096]
            want = self.library.encode("\n" + "\n".join(s for s, _ in part).replace(SPACE, " "))
            own = [*self._merged(SPACE), *(i for _, x in part for i in [*self.newline, *x])]
            if want != own:
                raise AssertionError("the library codes a stretch of text otherwise")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian numbers of 32 bits; an empty text has none."""
        cut = self.coarse.findall if self.coarse else self._stretches
        parted = [cut(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        self._learn(set().union(*parted))
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in parted]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the space before a text goes; bytes that make no character are ``LOST`` each."""
        if self.control.isdisjoint(ids):
            data = b"".join(map(self.bytes_of.__getitem__, ids))
            return (data[1:] if ids and self.opens[ids[0]] else data).decode("utf-8", "natatio-byte-by-byte")
        # A control piece adds nothing, but bytes on its two sides make no character together.
        parts, at = [], 0
        for k in [*(k for k, i in enumerate(ids) if i in self.control), len(ids)]:
            data = b"".join(map(self.bytes_of.__getitem__, ids[at:k]))
            parts.append((data[1:] if k > at and not any(parts) and self.opens[ids[at]] else data).decode("utf-8", "natatio-byte-by-byte"))
            at = k + 1
        return "".join(parts)


#: What this worker has read, by model and check; kept from task to task.
_LOADED: dict[tuple[bytes, int], Pieces] = {}


def _loaded(model: bytes, check: int) -> Pieces:
    return _LOADED.get((model, check)) or _LOADED.setdefault((model, check), Pieces(model, check))


def _sent(docs: DataFrame, model_file: str):
    with open(model_file, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of rows of about ``AT_ONCE`` in all; a longer row is one by itself."""
    first = held = 0
    for n, size in enumerate(sizes):
        if held and held + size > AT_ONCE:
            yield first, n
            first, held = n, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def encode_pieces(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", check: int = CHECKED, decode: bool = False) -> DataFrame:
    """``(doc_id, ids)``: the piece ids of every whole text, without ids for begin or end; with ``decode`` also ``decoded``, the text of these ids.

    The vocabulary must be of the merge type and leave texts as they are (else an error). The model file, of fixed size, is read by the driver and sent to the
    executors, which need not have it. Of the distinct stretches of text in each Arrow batch that are coded anew, one in ``check`` (by hash; 1: all, 0: none) is
    compared with the sentencepiece library's ids; a difference is an error. No shuffle.

    Null and empty texts have no ids (an empty array). Null and repeated document ids are kept, a row each. Texts of any length are coded whole. Other
    columns are ignored. An empty table gives an empty result.
    """
    model, rows = _sent(docs, model_file), docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model.value, check)
        for batch in batches:
            texts = batch.column(1)
            for a, b in _portions(pc.binary_length(texts).to_pylist()):
                found = pieces.encode(texts.slice(a, b - a).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
                columns = {"doc_id": batch.column(0).slice(a, b - a), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))}
                if decode:
                    columns["decoded"] = pa.array([pieces.decode(np.frombuffer(x, "<i4").tolist()) for x in found], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(code, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decode)


def decode_pieces(coded: DataFrame, model_file: str) -> DataFrame:
    """``(doc_id, ids, decoded)``: the text of each row's ids, as the library decodes them.

    Null ids have the null text, an empty array the empty one. Ids that the model doesn't have are an error.
    """
    model, rows = _sent(coded, model_file), coded.select("doc_id", "ids")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model.value, CHECKED)
        for batch in batches:
            column = batch.column(1)
            for a, b in _portions(column.value_lengths().fill_null(0).to_pylist()):
                part = column.slice(a, b - a)
                texts = pa.array([None if x is None else pieces.decode(x) for x in part.to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), part, texts], names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(read, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")
