"""Token counts with a shortcut for pre-tokens that are one token each.

Which strings of the vocabulary encode alone as one token is proven once, on the
driver, by merging every one of them. Tasks then count a pre-token among them as one
and merge only the rest. The text is cut into pre-tokens by the byte-level rule:
contractions, letters, digits or other signs with at most one space before them,
and runs of white space. Special strings inside a text are one token each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.merging import NEVER, merge_adjacent

# The contractions and character classes of the byte-level pre-tokenizer.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The same classes spelt out for texts below U+0180, which the standard library matches faster.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
LATIN_PRE_TOKENS = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
BEYOND_LATIN = "[^\x00-ſ]"
KEPT_WORDS = 700_000  # merged pre-tokens a worker remembers; beyond it merges anew
KEPT_LENGTH = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


class _Counts(dict):
    """Tokens of each pre-token; one not yet known is merged."""

    def __init__(self, whole: set[str], ranks: dict[tuple[str, str], int]):
        super().__init__(dict.fromkeys(whole, 1))
        self.ranks, self.letters = ranks, byte_letters()

    def __missing__(self, word: str) -> int:
        symbols = [self.letters[b] for b in word.encode()]
        n = len(merge_adjacent(symbols, lambda a, b: self.ranks.get((a, b), NEVER)))
        if len(self) < KEPT_WORDS and len(word) <= KEPT_LENGTH:
            self[word] = n
        return n


class TokenCounter:
    """Counts tokens as the vocabulary file ``data`` (JSON, byte-level merges) gives them."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level merge vocabularies without a normalizer are supported")
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens that strip their neighbours are not supported")
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = "|".join(map(re.escape, special))
        self.whole = self._prove(model["vocab"])
        self._counts: _Counts | None = None

    def _prove(self, vocab: dict[str, int]) -> set[str]:
        """The strings of the vocabulary that merge into one symbol, as text."""
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        whole = set()
        for token in vocab:
            if not all(c in byte_of for c in token):
                continue
            if len(merge_adjacent(list(token), lambda a, b: self.ranks.get((a, b), NEVER))) == 1:
                try:
                    whole.add(bytes(byte_of[c] for c in token).decode())
                except UnicodeDecodeError:
                    continue  # part of a character: never a whole pre-token
        return whole

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("ranks", "special", "whole")} | {"_counts": None}

    def count(self, text: str) -> int:
        if self._counts is None:
            self._counts = _Counts(self.whole, self.ranks)
            self._beyond = re.compile(BEYOND_LATIN).search
            self._latin, self._any = re.compile(LATIN_PRE_TOKENS).findall, regex.compile(PRE_TOKENS).findall
            self._split = re.compile(self.special).split if self.special else lambda text: [text]
        known = self._counts.__getitem__
        find = self._any if self._beyond(text) else self._latin
        parts = self._split(text)
        return len(parts) - 1 + sum(sum(map(known, find(part))) for part in parts)


def count_tokens(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row.

    A null text counts as empty: no bytes, no tokens. Rows are handled one by one, so
    repeated rows and null ids stay as they are; other columns are not read. The
    broadcast holds the vocabulary only, whose size is that of its file.
    """
    model = docs.sparkSession.sparkContext.broadcast(TokenCounter(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = model.value
        for batch in batches:
            words = [x.as_py() or "" for x in batch.column(1)]
            sizes = [len(w.encode()) for w in words]
            tokens = [counter.count(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"])

    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = source.schema[0].dataType.simpleString()
    counted = source.mapInArrow(count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
