"""Best-fit packing of tokenised documents into sequences, improved by swaps.

Documents are tokenised once; longer ones than a sequence are cut, and pieces
go to blocks of bounded size by a hash. Each block packs best-fit decreasing
and then searches locally: the emptiest sequence gives documents away by moves,
exchanges one for one, two for one or one for two, each of which raises the sum
of squared fills, until it is empty or nothing fits. What the blocks leave in
badly filled sequences is packed again together, round by round, in fewer blocks.

Null texts are empty documents (the closing id only); repeated rows are
packed as often as they occur.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from haulwright.llm.bpe import Recent
from haulwright.llm.common import byte_symbols, key_groups, mapped, steps, stored, table, unused

SEQUENCE = 2048
#: Pieces in a block, whatever the number of documents.
BLOCK = 20_000

# Kinds of bytes: 0 white space, 1 letter, 2 digit (a unit by itself), 3 mark; a word with a byte of kind 4, which may
# be part of a larger character, a contraction or a special token, is one unit, and so is a text with one of kind 5,
# which is white space to some and not to others.
_SPACE, _LETTER, _DIGIT, _MARK, _WORD, _TEXT = range(6)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[*range(9, 14), 32]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[*range(128, 256), *b"'<"]] = _WORD
_KIND[28:32] = _TEXT
# Letters of two bytes that have one form only and a lower case 32 behind: U+00C0 to U+00FF but the two signs among them.
_LATIN, _LATIN_SIGNS = 0xC3, (0x97, 0xB7)
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:;=-@[-`{-\x7f\x00-\x08\x0e-\x1b]+")


class WordIds:
    """Ids of texts for a vocabulary that drops white space and case and sets letters, digits and marks apart.

    All texts of a step are cut into units at once, and only distinct units are encoded.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks run side by side already
        self.library = Tokenizer.from_file(file)
        self.model, self.symbols = self.library.model, dict(enumerate(byte_symbols()))
        self.recent = Recent(self._ids, most=200_000)
        for probe in ("Aé1 b,\nC.\t<x> d", "Ab12c..,;d -- E'F x's \x00y", "ÀÉß×÷ÿ, Straße!! öl&&& 日本 ¿q?"):
            if self.library.encode(probe, add_special_tokens=False).ids != np.frombuffer(self.encode(probe), "<u4").tolist():
                raise ValueError("the vocabulary encodes words together")

    def _ids(self, unit: bytes) -> bytes:
        if _PLAIN.fullmatch(unit):  # nothing to normalise or to split
            text = unit.decode() if unit.isascii() and unit.isalnum() else unit.decode("latin-1").translate(self.symbols)
            ids = [t.id for t in self.model.tokenize(text)]
        else:
            ids = self.library.encode(unit.decode(errors="replace"), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _units(self, raw: bytes, first: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Units of texts with a line end behind each (`first`: where they start), and each text's first unit."""
        data = np.frombuffer(raw, np.uint8)
        kind = _KIND[data]
        ends = np.append(first[1:], len(data)) - 1
        if (kind == _TEXT).any():
            for row in np.unique(np.searchsorted(first, np.flatnonzero(kind == _TEXT), "right") - 1).tolist():
                kind[first[row] : ends[row]] = _TEXT
        latin = np.flatnonzero((data == _LATIN) & (kind == _WORD))
        behind = data[latin + 1]
        known = (behind >= 0x80) & (behind != _LATIN_SIGNS[0]) & (behind != _LATIN_SIGNS[1])
        latin, behind = latin[known], behind[known]
        kind[latin] = kind[latin + 1] = _LETTER
        odd = np.flatnonzero(kind == _WORD)
        if len(odd):
            spaces = np.flatnonzero(kind == _SPACE)
            word = np.unique(np.searchsorted(spaces, odd))
            inside = np.zeros(len(data) + 1, np.int8)
            inside[np.where(word > 0, spaces[word - 1] + 1, 0)] = 1
            inside[spaces[word]] = -1
            kind[(np.cumsum(inside[:-1], dtype=np.int8) == 1)] = _WORD
        used = kind != _SPACE
        begins = used & ((kind != np.append(_SPACE, kind[:-1])) | (kind == _DIGIT))
        lower = np.where((kind == _LETTER) & (data < 91), data + np.uint8(32), data)
        upper = latin[(behind < 0x9F) & (kind[latin] == _LETTER)] + 1
        lower[upper] += 32
        lower = lower[used]
        at = np.flatnonzero(begins)
        offsets = np.append(np.cumsum(used)[at] - 1, len(lower)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(lower)])
        return units, np.searchsorted(at, np.append(first, len(data)))

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and where each text's ids start (and the last one's end)."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        units, rows = self._units(b"\n".join(texts) + b"\n", np.cumsum(sizes) - sizes)
        coded = units.dictionary_encode()
        known = list(map(self.recent.__getitem__, coded.dictionary.to_pylist()))
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids, starts = np.frombuffer(b"".join(known), "<u4"), np.cumsum(lengths) - lengths
        place = coded.indices.to_numpy()
        own = lengths[place]
        before = np.append(0, np.cumsum(own))
        found = ids[np.arange(before[-1]) + np.repeat(starts[place] - before[:-1], own)]
        return found, before[rows]

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit numbers, little end first."""
        return self.encode_all([text.encode(errors="replace")])[0].tobytes()


_encoders: dict[str, WordIds] = {}


def encoder(file: str) -> WordIds:
    """One encoder for each vocabulary file and Python worker."""
    if file not in _encoders:
        _encoders[file] = WordIds(file)
    return _encoders[file]


def pieces(docs: DataFrame, file: str, most: int = SEQUENCE, closing: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most `most` ids of each row: key, piece, start, length, ids_crc32."""
    names = [key, "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(file), closing.to_bytes(4, "little")
        for batch in steps(batches, text):
            rows, columns = [], ([], [], [], [])
            ids, starts = own.encode_all([t or b"" for t in batch.column(text).cast(pa.large_binary()).to_pylist()])
            coded, starts = memoryview(ids.astype("<u4", copy=False)).cast("B"), starts.tolist()
            for row, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                for number, start in enumerate(range(0, b - a + 1, most)):
                    length = min(most, b - a + 1 - start)
                    crc = zlib.crc32(coded[4 * (a + start) : 4 * min(a + start + length, b)])
                    if start + length > b - a:  # the closing id is the last one
                        crc = zlib.crc32(end, crc)
                    rows.append(row)
                    for c, v in zip(columns, (number, start, length, crc), strict=True):
                        c.append(v)
            numbers = [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(rows)), *numbers], names)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).transform(mapped, run, f"{key} {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, most: int) -> np.ndarray:
    """Bin of each length by best fit, longest first (ties in order)."""
    bins = np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(most + 1)]
    open_rooms, opened = 0, 0  # bit r is set if a bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = open_rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                open_rooms ^= 1 << room
        else:
            room, chosen, opened = most, opened, opened + 1
        bins[item] = chosen
        room -= length
        if room:
            with_room[room].append(chosen)
            open_rooms |= 1 << room
    return bins


class Search:
    """Local search on a packing; each step raises the sum of squared fills."""

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, most: int):
        self.lengths, self.bins, self.most = lengths, bins.copy(), most
        self.fill = np.bincount(bins, lengths).astype(np.int64) if len(bins) else np.zeros(0, np.int64)
        # only bins with room take part: full ones can gain nothing
        self.items = np.flatnonzero(self.fill[bins] < most) if len(bins) else bins
        self.size, self.place = lengths[self.items], self.bins[self.items]

    def least(self) -> int:
        """Bins that the given lengths need at least."""
        return -(-int(self.lengths.sum()) // self.most)

    def _shift(self, member: int, target: int) -> None:
        self.fill[self.place[member]] -= self.size[member]
        self.fill[target] += self.size[member]
        self.place[member] = target

    def _move(self, member: int, source: int) -> bool:
        length = self.size[member]
        room = self.most - self.fill
        fits = (room >= length) & (self.fill > 0) & (self.fill + length > self.fill[source])
        fits[source] = False
        if not fits.any():
            return False
        self._shift(member, int(np.where(fits, room, self.most + 1).argmin()))
        return True

    def _exchange(self, given: list[int], source: int, lowest: int) -> bool:
        """Give members of the source for one smaller document elsewhere, to fill that bin best."""
        length = int(self.size[given].sum())
        left = self.most - self.fill[self.place] + self.size - length  # room there afterwards
        fits = (self.place != source) & (self.size < length) & (self.size >= lowest) & (left >= 0)
        if not fits.any():
            return False
        taken = int(np.where(fits, left, self.most + 1).argmin())
        target = int(self.place[taken])
        if self.fill[target] + length - self.size[taken] <= self.fill[source]:
            return False
        for member in given:
            self._shift(member, target)
        self._shift(taken, source)
        return True

    def _two_for_one(self, member: int, source: int) -> bool:
        """Give one member of the source for two smaller documents of one other bin."""
        length = self.size[member]
        order = np.lexsort((self.size, self.place))
        place, size = self.place[order], self.size[order]
        pair = (place[1:] == place[:-1]) & (place[1:] != source)
        both = size[1:] + size[:-1]
        left = self.most - self.fill[place[1:]] + both - length
        fits = pair & (both < length) & (left >= 0)
        if not fits.any():
            return False
        at = int(np.where(fits, left, self.most + 1).argmin())
        target = int(place[at])
        if self.fill[target] + length - both[at] <= self.fill[source]:
            return False
        self._shift(member, target)
        self._shift(int(order[at]), source)
        self._shift(int(order[at + 1]), source)
        return True

    def run(self) -> np.ndarray:
        """Bins after the search; emptied ones are gone from the numbers used."""
        needed = self.least()
        tried: set[int] = set()
        while int((self.fill > 0).sum()) > needed:
            waiting = np.where((self.fill > 0) & (self.fill < self.most), self.fill, self.most + 1)
            if tried:
                waiting[list(tried)] = self.most + 1
            source = int(waiting.argmin())
            if waiting[source] > self.most:
                break
            if not self._empty(source):
                tried.add(source)
        self.bins[self.items] = self.place
        return self.bins

    def _empty(self, source: int) -> bool:
        while True:
            members = np.flatnonzero(self.place == source)
            members = members[np.argsort(-self.size[members], kind="stable")].tolist()
            if not members:
                return True
            step = any(self._move(m, source) for m in members) or any(
                self._exchange([m], source, 1) for m in members
            )
            step = step or any(self._exchange([a, b], source, 1) for a, b in zip(members, members[1:], strict=False))
            step = step or any(self._two_for_one(m, source) for m in members)
            if not step:
                return False


def pack_block(lengths: np.ndarray, most: int = SEQUENCE) -> np.ndarray:
    """Bin of each length in a block."""
    return Search(lengths, best_fit(lengths, most), most).run()


def pack(items: DataFrame, most: int = SEQUENCE, block: int = BLOCK) -> DataFrame:
    """The rows (with a column length) with sequence_id and offset, in blocks and rounds.

    A round packs what is left in as many blocks as its rows need. Sequences at
    least 99 % full, and all of the last round, are done; the others' rows
    go to the next round, which ends with one block or when a round frees less
    than a tenth of its rows.
    """
    names = [unused(name, items.columns) for name in ("row", "block", "fill")]
    number, _, fill = names
    rest = items.drop("sequence_id", "offset").withColumn(number, F.monotonically_increasing_id())
    done: list[DataFrame] = []
    count, turn = rest.count(), 0
    kept = [f.name for f in items.schema if f.name not in ("sequence_id", "offset")]
    while True:
        blocks = max(1, math.ceil(count / block))
        packed = stored(_packed(rest, most, blocks, turn, names), "packed")
        if blocks == 1:
            done.append(packed)
            break
        good = F.col(fill) >= F.lit(0.99 * most)
        rest = packed.where(~good).drop("sequence_id", "offset", fill)
        left = rest.count()
        if left > 0.9 * count or not left:
            done.append(packed)
            break
        done.append(packed.where(good))
        count, turn = left, turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*kept, "sequence_id", "offset")


def _packed(rows: DataFrame, most: int, blocks: int, turn: int, names: list[str]) -> DataFrame:
    row, block, fill_name = names
    keyed = rows.withColumn(block, F.pmod(F.xxhash64(F.col(row), F.lit(turn)), F.lit(blocks)).cast("long"))
    keyed = keyed.repartition(min(blocks, 4096), block).sortWithinPartitions(block, row)
    base = turn << 56

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, group in key_groups(batches, block):
            lengths = group.column("length").to_numpy().astype(np.int64)
            bins = pack_block(lengths, most)
            order = np.argsort(bins, kind="stable")
            before = np.cumsum(lengths[order]) - lengths[order]
            first = np.r_[True, np.diff(bins[order]) != 0]
            starts = np.maximum.accumulate(np.where(first, before, 0))
            fill = np.bincount(bins, lengths)[bins[order]].astype(np.int64)
            out = group.take(pa.array(order)).drop_columns([block])
            out = out.append_column("sequence_id", pa.array(base + (int(number) << 24) + bins[order]))
            out = out.append_column("offset", pa.array(before - starts)).append_column(fill_name, pa.array(fill))
            yield from out.combine_chunks().to_batches()

    added = [T.StructField(name, T.LongType()) for name in ("sequence_id", "offset", fill_name)]
    return keyed.transform(mapped, run, T.StructType([*rows.schema, *added]))


def pack_documents(docs: DataFrame, file: str, most: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return pack(stored(pieces(docs, file, most), "pieces"), most)


def op5_best_fit_packing(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return pack_documents(documents, public_tokenizers.path("word_bpe_49k.json"))
