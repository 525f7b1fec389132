"""Encoding and decoding with a merge-type piece vocabulary.

A text gets a leading space, spaces become the sign U+2581, and an agenda of adjacent
symbol pairs is worked off by score, then from left to right; what is left and not in
the vocabulary falls back to its bytes. Texts are cut into words so that every piece of the
vocabulary lies within a word (this is checked when it is loaded); no merge crosses such a
cut, so a word is merged on its own, once per worker while it is remembered. Each
Arrow batch hands the words it has met for the first time to the sentencepiece
library and fails if the library's ids differ. The lone space sign and words that begin with a
line break are left out of this. The first text of each batch and one in ``WHOLE`` are compared as a whole, and so is the cut into
words; texts with NUL or code points from U+30000 on aren't.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.merging import NEVER, merge_adjacent

SPACE = "▁"
# Ways to cut a text into words, the finest first; one holds if every piece lies within a word.
WORDS = (
    rf"{SPACE}*[^\W\d_²³¹¼-¾]+|{SPACE}*\d+|{SPACE}*(?:[^\w{SPACE}]|[_²³¹¼-¾])+|{SPACE}+",
    f"{SPACE}*[^{SPACE}]+|{SPACE}+",
)
KEPT_WORDS = 1_000_000
KEPT_LENGTH = 64
WHOLE = 64  # one text in so many
UNCOMPARED = re.compile("[\0\U00030000-\U0010ffff]")


class PieceModel:
    """The pieces and scores of a model file's bytes."""

    def __init__(self, data: bytes):
        self.data = data
        library = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        plain = [i for i in range(len(pieces))
                 if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
        if any(library.is_unused(i) for i in plain):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.ids = {pieces[i]: i for i in plain}
        self.order = {pieces[i]: -library.get_score(i) for i in plain}
        self.byte_ids = {int(pieces[i][3:5], 16): i for i in range(len(pieces)) if library.is_byte(i)}
        self.pieces = {i: pieces[i] for i in plain}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.unknown, self.end = library.unk_id(), library.eos_id()
        if len(self.byte_ids) != 256 or self.end < 0:
            raise ValueError("the vocabulary must have all bytes and an end id")
        # Words are independent only if no piece joins two of them.
        self.known: _Known | None = None  # what a worker remembers
        self.pattern = next((p for p in WORDS if all(len(re.findall(p, piece)) == 1 for piece in self.ids)), None)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return re.findall(self.pattern, marked) if self.pattern else [marked]

    def encode_word(self, word: str) -> list[int]:
        order, found = self.order, []
        for symbol in merge_adjacent(list(word), lambda a, b: order.get(a + b, NEVER)):
            if (known := self.ids.get(symbol)) is not None:
                found.append(known)
            else:
                found += [self.byte_ids[b] for b in symbol.encode()]
        return found

    def encode(self, text: str, end: bool = True) -> list[int]:
        ids = [i for word in self.words(text) for i in self.encode_word(word)]
        return ids + [self.end] if end else ids

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: the first leading space goes, the end id has no text."""
        return self._surface(ids).removeprefix(" ")

    def _surface(self, ids: list[int]) -> str:
        data = bytearray()
        for i in ids:
            if i in self.byte_of:
                data.append(self.byte_of[i])
            elif i in self.pieces:
                data += self.pieces[i].replace(SPACE, " ").encode()
        return data.decode(errors="replace")


class _Known(dict):
    """The ids of each word as text; one not yet known is encoded, decoded and noted in ``fresh``.

    ``odd`` has the words whose decoded text isn't the word with spaces for its signs.
    """

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model, self.fresh, self.odd = model, [], {}

    def __missing__(self, word: str) -> str:
        ids = self.model.encode_word(word)
        self.fresh.append((word, ids))
        if (decoded := self.model._surface(ids)) != word.replace(SPACE, " "):
            self.odd[word] = decoded
        text = " ".join(map(str, ids))
        if len(word) <= KEPT_LENGTH and len(self) < KEPT_WORDS:
            self[word] = text
        return text

    def encode(self, words: list[str]) -> str:
        return " ".join([*map(self.__getitem__, words), str(self.model.end)])

    def decode(self, words: list[str]) -> str:
        """The decoded text of words that have been encoded."""
        if self.odd and not self.odd.keys().isdisjoint(words):
            return "".join(self.odd.get(w, w.replace(SPACE, " ")) for w in words).removeprefix(" ")
        return "".join(words).replace(SPACE, " ").removeprefix(" ")

    def compare(self, library: sentencepiece.SentencePieceProcessor) -> None:
        """Holds the new words against the library and forgets that they are new."""
        marked = [(w, ids) for w, ids in self.fresh if w[0] == SPACE and len(w) > 1]
        inner = [(w, ids) for w, ids in self.fresh if w[0] not in (SPACE, "\n")]
        # The library itself puts a sign before a text; a word without one is held against it behind a line break.
        for some, before, lead in ((marked, "", []), (inner, "\n", library.encode("\n"))):
            own = [before + w.removeprefix(SPACE).replace(SPACE, " ") for w, _ in some]
            for (word, ids), theirs in zip(some, library.encode(own, num_threads=1)):
                if lead + ids != theirs:
                    raise ValueError(f"{word!r}: {ids} here, {theirs[len(lead):]} in the library")
        self.fresh = []


def _compared_whole(text: str, first: bool) -> bool:
    """The first text of a batch, and one in ``WHOLE`` by its hash, are compared with the library as a whole, and with them the cut into words."""
    return (first or zlib.crc32(text.encode()) % WHOLE == 0) and len(text) <= 1 << 20 and not UNCOMPARED.search(text)


def encode_decode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False, check: bool = True) -> DataFrame:
    """Ids with the end id, and the text decoded from them, for every row.

    Returns ``id_col``, n_tokens, ids_sha256 (of the ids in decimal, one space between) and
    decoded_sha256 (of the decoded text); ``with_ids`` adds token_ids and decoded. A
    null text counts as empty and has the end id alone. Rows are handled one by one:
    repeated rows and null ids stay as they are; other columns are not read. The
    broadcast holds the vocabulary only. ``check`` compares new words and some whole texts with the library, see above for those left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(PieceModel(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        library = sentencepiece.SentencePieceProcessor(model_proto=model.data) if check else None
        if model.known is None:
            model.known = _Known(model)
        known = model.known
        for batch in batches:
            id_texts, decoded = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                words = model.words(text)
                id_texts.append(known.encode(words))
                decoded.append(known.decode(words))
                if library is not None and _compared_whole(text, len(id_texts) == 1):
                    theirs = library.encode(text, add_eos=True)
                    if id_texts[-1] != " ".join(map(str, theirs)) or decoded[-1] != library.decode(theirs):
                        raise ValueError(f"a text of {len(text)} characters differs from the library's: {text[:80]!r}")
            counts = [x.count(" ") + 1 for x in id_texts]
            if library is not None:
                known.compare(library)
            known.fresh = []
            sha = lambda values: pa.array([hashlib.sha256(v.encode()).hexdigest() for v in values], pa.string())
            columns = [batch.column(0), pa.array(counts, pa.int64()), sha(id_texts), sha(decoded)]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array([[*map(int, x.split())] for x in id_texts], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["token_ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    schema = f"`{id_col}` {source.schema[0].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(run, schema + (", token_ids array<int>, decoded string" if with_ids else ""))
