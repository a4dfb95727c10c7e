"""Token counts of every prefix of a text by dynamic programming.

The counter cuts a text into units in front of single spaces and line ends
(where the tokenizer's own splitting cuts, too), and a `PrefixTable` gives each
unit the exact token count of each of its prefixes. Totals, the longest prefix
within a budget and the count at any place follow from these without encoding
again. Null texts are empty and count 0 tokens.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from haulwright.llm.bpe import PrefixTable, Recent
from haulwright.llm.common import byte_symbols, mapped, steps, table, texts_of

# The splitting pattern of the byte-level vocabulary, and its contractions of three characters.
_SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
_ODD_SPACE = re.compile(r"[^\S \n]")


class PrefixCounter:
    """Counts the tokens of prefixes with one vocabulary file."""

    def __init__(self, file: str):
        model = json.loads(Path(file).read_text())
        vocab = model["model"]["vocab"]
        tokens: list[str | None] = [None] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            tokens[i] = t
        self.special = [t["content"] for t in model["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in model["added_tokens"]):
            raise ValueError("special tokens that take spaces with them are not covered")
        for t in model["added_tokens"]:
            if t["id"] < len(tokens):
                tokens[t["id"]] = None
        ranks = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.table = PrefixTable(tokens, lambda a, b: ranks.get((a, b)), lambda c: [])
        self.library = Tokenizer.from_file(file)
        self.symbols = dict(enumerate(byte_symbols()))
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.recent = Recent(self._total)

    def _symbols(self, part: str) -> str:
        return part.encode().decode("latin-1").translate(self.symbols)

    def _parts(self, unit: str) -> list[str]:
        return [unit] if unit.isalpha() else _SPLIT.findall(unit)

    def _total(self, key: str) -> int:
        """Tokens of a unit as `_units` writes it."""
        return sum(self.table.counts(self._symbols(p))[-1] for p in self._parts(self._unit_text(key)))

    @staticmethod
    def _unit_text(key: str) -> str:
        return key[1:] if key[0] == " " else key if key[0] == "\n" else " " + key

    def _units(self, text: str) -> list[str] | None:
        """Units of a text (first one marked, the others without their space), None if it has other spaces."""
        spaced = text.replace("\n", " \n")
        if spaced[0] == " " or spaced[-1] in " \n" or "  " in spaced or "\n " in spaced or _ODD_SPACE.search(text):
            return None
        keys = spaced.split(" ")
        keys[0] = " " + keys[0]
        return keys

    def _segments(self, text: str) -> list[str]:
        """A text cut around special tokens, which are segments of their own."""
        if any(s in text for s in self.special):
            return [s for s in self.special_split.split(text) if s]
        return [text] if text else []

    def total(self, text: str) -> int:
        """Tokens of the whole text."""
        count = 0
        for segment in self._segments(text):
            if segment in self.special:
                count += 1
            elif (keys := self._units(segment)) is not None:
                count += sum(map(self.recent.__getitem__, keys))
            else:
                for part, _ in self.library.pre_tokenizer.pre_tokenize_str(segment):
                    count += self.table.counts(part)[-1]
        return count

    def prefixes(self, text: str) -> list[int]:
        """Tokens of text[:i] for every i from 0 to its length."""
        found, base = [0], 0
        plain, before = "", 0  # the ordinary segment that ends here, tokens before it
        for segment in self._segments(text):
            if segment in self.special:
                for i in range(1, len(segment)):  # part of a special token is ordinary text
                    found.append(before + self._prefixes_plain(plain + segment[:i])[-1])
                base += 1
                found.append(base)
                plain, before = "", base
            else:
                own = self._prefixes_plain(segment)
                plain, before = segment, base
                found += [base + n for n in own[1:]]
                base += own[-1]
        return found

    def _prefixes_plain(self, segment: str) -> list[int]:
        found, base, run_start, run_base = [0], 0, None, 0
        at = 0
        for part, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(segment):
            text = segment[start:end]
            own = self._by_character(text)
            for i in range(1, len(text) + 1):
                c = text[i - 1]
                if c.isspace():  # a prefix that ends in a run of spaces ends in one part
                    if run_start is None:
                        run_start, run_base = at + i - 1, found[at + i - 1]
                    run = segment[run_start : at + i]
                    found.append(run_base + self.table.counts(self._symbols(run))[-1])
                else:
                    run_start = None
                    cut = i == 2 and text in _LONG_CONTRACTIONS
                    found.append(base + (self._by_character(text[0])[-1] + 1 if cut else own[i]))
            base += own[-1]
            at = end
        return found

    def _by_character(self, part: str) -> list[int]:
        counts = self.table.counts(self._symbols(part))
        ends = [0, *accumulate(len(c.encode()) for c in part)]
        return [counts[e] for e in ends]

    def within(self, text: str, budget: int) -> int:
        """Characters of the text's longest run of whole units from its start within a budget of tokens,
        continued inside the next unit by that unit's own table."""
        at, left = 0, budget
        for segment in self._segments(text):
            if segment in self.special:
                if left < 1:
                    return at
                at, left = at + len(segment), left - 1
                continue
            keys = self._units(segment)
            texts = [self._unit_text(k) for k in keys] if keys is not None else None
            if texts is None:
                parts = self.library.pre_tokenizer.pre_tokenize_str(segment)
                texts = [segment[a:b] for _, (a, b) in parts]
                sums = list(accumulate(self.table.counts(p)[-1] for p, _ in parts))
            else:
                sums = list(accumulate(map(self.recent.__getitem__, keys)))
            full = bisect_right(sums, left)
            at += sum(map(len, texts[:full]))
            if full < len(texts):
                room = left - (sums[full - 1] if full else 0)
                own = self._prefixes_plain(texts[full])
                return at + max(i for i, n in enumerate(own) if n <= room)
            left -= sums[-1]
        return at


_counters: dict[str, PrefixCounter] = {}


def counter(file: str) -> PrefixCounter:
    """One counter for each vocabulary file and Python worker."""
    if file not in _counters:
        _counters[file] = PrefixCounter(file)
    return _counters[file]


def token_counts(docs: DataFrame, file: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit and chars_within (characters of the text that fit the limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(file)
        for batch in steps(batches, text):
            texts = texts_of(batch.column(text))
            totals = [own.total(t) for t in texts]
            inside = [len(t) if n <= limit else own.within(t, limit) for t, n in zip(texts, totals, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([n > limit for n in totals]),
                    pa.array(inside, pa.int64()),
                ],
                names=[key, "n_bytes", "n_tokens", "over_limit", "chars_within"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).transform(
        mapped, run, f"{key} {kind}, n_bytes long, n_tokens long, over_limit boolean, chars_within long"
    )


def op9_token_counts(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return token_counts(documents, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
