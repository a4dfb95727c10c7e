"""SentencePiece encoding and decoding by a prefix table of last tokens.

The vocabulary is a merge-type one with byte fallback. A text is cut where no
piece can reach across (before a space mark that follows something else,
around symbols without a piece), and each unit is encoded by `PrefixTable`;
units are remembered, as words repeat. Null texts are empty, empty texts have
no piece; other columns pass through only if they are asked for in `keep`, the
result's own names win over them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from haulwright.llm.bpe import PrefixTable, Recent
from haulwright.llm.common import mapped, steps, table, texts_of

MARK = "▁"
_UNITS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class PieceCoder:
    """Encodes and decodes with one model file."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        ordinary = lambda i: not (
            model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)
        )
        pieces = [model.id_to_piece(i) if ordinary(i) else None for i in ids]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces if p):
            raise ValueError("a piece reaches over a space or line end")
        if model.normalize("  a\t ﬁ ") != f"{MARK * 3}a\t{MARK}ﬁ{MARK}":
            raise ValueError("the model changes texts beyond marking spaces")
        by_text = {p: i for i, p in enumerate(pieces) if p}
        scores = [model.get_score(i) for i in ids]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]

        def merge(left: int, right: int):
            found = by_text.get(pieces[left] + pieces[right])
            return None if found is None else (-scores[found], found)

        self.end_id = model.eos_id()
        self.table = PrefixTable(pieces, merge, lambda c: [byte_ids[b] for b in c.encode()])
        self.bytes_of = [p.replace(MARK, " ").encode() if p else b"" for p in pieces]
        for b, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([b])
        self.recent = Recent(self._unit)

    def _unit(self, unit: str) -> tuple[int, bytes, bytes]:
        ids = self.table.encode(unit)
        return len(ids), b"".join(b"%d " % i for i in ids), b"".join(map(self.bytes_of.__getitem__, ids))

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if MARK * 2 in marked or marked[-1] == MARK or "\x00" in marked:
            return _UNITS.findall(marked)
        return [
            u for u in marked.replace(MARK, "\x00" + MARK).replace("\n", "\x00\n\x00").split("\x00") if u
        ]

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without begin or end."""
        return [i for u in self.units(text) for i in self.table.encode(u)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the mark put before the text is taken off again."""
        joined = b"".join(map(self.bytes_of.__getitem__, ids))
        return joined.removeprefix(b" ").decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids with the end id, hash of the ids, hash of the text decoded from them."""
        found = list(map(self.recent.__getitem__, self.units(text)))
        ids = b"".join([f[1] for f in found]) + b"%d" % self.end_id
        decoded = b"".join([f[2] for f in found]).removeprefix(b" ")
        return (
            sum([f[0] for f in found]) + 1,
            hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest(),
        )


_coders: dict[str, PieceCoder] = {}


def coder(model_file: str) -> PieceCoder:
    """One coder for each model file and Python worker."""
    if model_file not in _coders:
        _coders[model_file] = PieceCoder(model_file)
    return _coders[model_file]


def encode_texts(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (array of int, end id last) and the text decoded from them, one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model_file)
        for batch in steps(batches, text):
            ids = [[*own.encode(t), own.end_id] for t in texts_of(batch.column(text))]
            decoded = [own.decode(i[:-1]) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                names=[key, "ids", "decoded"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).transform(mapped, run, f"{key} {kind}, ids array<int>, decoded string")


def piece_digests(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of each row: the digests of `encode_texts`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model_file)
        for batch in steps(batches, text):
            n, ids, decoded = zip(*map(own.digest, texts_of(batch.column(text))), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).transform(
        mapped, run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op10_sentencepiece(spark, folder: str) -> DataFrame:
    return piece_digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
