"""Collocations of two to four words, by top-order marginalisation.

Only the longest windows are counted: every word with the three that lead on from it, padded where its piece of
text ends. Whatever is shorter is a sum of them. The windows are dealt by their first words and sorted, so that a task sums those of
three words and what it has of each pair; these sums are written, and Spark's ROLLUP adds up pairs and single words from them.

What makes the windows small is a codebook of the most frequent words: three words are one 63-bit number. Words that
occur too seldom to be part of a candidate pad the window like the end of a piece. If there are more frequent words than the
codebook holds, the others, and all words then, are spelled out beside the number; nothing is left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import by_bytes, checkpointed, utf8, word_spans
from tabflow.session import fresh_path, remove_path

LONGEST = 4  # three words fit one number beside the fourth
CODE_BITS = 21
PAD, SPELLED = 0, (1 << CODE_BITS) - 1
SAID = ["spelled", "last_spelled"]
MOST_CODES = 1_000_000  # words in the codebook, which is broadcast: some 20 MB
BATCH_BYTES = 4 << 20
FLUSH = 1 << 21  # windows that are counted together before they leave a task
SPREAD = 8  # tasks that share the windows of a pair of words
BLOCK_ROWS = 100_000  # candidates ranked in one task

# Lower case for A-Z; every mark that ends a piece becomes a line break.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A"):ord("Z") + 1] += 32
_PLAIN[list(b".,;:!?\n\x0b\x0c\r")] = 10


class Words:
    """The words of some texts: ``array`` in Arrow form, their ``text``, and whether the next one is in the same piece."""

    def __init__(self, data: np.ndarray, starts: np.ndarray) -> None:
        data = _PLAIN[data]
        begin, end, self.text = word_spans(data, starts)
        ends = np.r_[0, np.cumsum(end - begin)].astype(np.int64)
        letters = data[(data != 32) & (data != 9) & (data != 10)]
        self.array = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
        piece = np.cumsum(data == 10)[begin]
        self.goes_on = np.zeros(len(begin), bool)
        self.goes_on[:-1] = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[tuple[str, str]], np.ndarray]]:
    """Of texts in blocks: their words, the different (lang, word) among them, and which of these each word is."""
    for batch in batches:
        data, starts = utf8(batch.column(1))
        langs = batch.column(0).dictionary_encode()
        names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        for lo, hi in by_bytes(starts, BATCH_BYTES):
            words = Words(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
            if not len(words.array):
                continue
            spelled = words.array.dictionary_encode()
            distinct = spelled.dictionary.to_pylist()
            here, used = np.unique(lang[lo:hi], return_inverse=True)
            pair = used[words.text] * len(distinct) + spelled.indices.to_numpy()
            present = np.zeros(len(here) * len(distinct), bool)
            present[pair] = True
            pairs = [(names[here[p // len(distinct)]], distinct[p % len(distinct)]) for p in np.flatnonzero(present).tolist()]
            yield words, pairs, (np.cumsum(present) - 1)[pair]


def _vocabulary(source: DataFrame, least: int) -> DataFrame:
    """lang, word, n of the words that occur ``least`` times in a language; and lang, null, n: all its words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pairs, which in _by_lang(batches):
            langs, words = zip(*pairs)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(np.bincount(which))], names=["lang", "word", "n"])

    counts = source.mapInArrow(count, "lang string, word string, n bigint")
    summed = counts.rollup("lang", "word").agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    return checkpointed(summed.where((F.col("level") == 1) | ((F.col("level") == 0) & (F.col("n") >= least))).drop("level"))


_known: dict[str, tuple[dict, list]] = {}


def _codebook(blob, name: str) -> tuple[dict[tuple[str, str], int], list[tuple[str, str]]]:
    """Codes by (lang, word), and (lang, word) by code less one; one codebook is kept in a worker."""
    if name not in _known:
        table = pa.ipc.open_stream(blob.value).read_all()
        entries = list(zip(table["lang"].to_pylist(), table["word"].to_pylist()))
        _known.clear()
        _known[name] = {e: i + 1 for i, e in enumerate(entries)}, entries
    return _known[name]


def _lead(codes: np.ndarray, goes_on: np.ndarray) -> list[np.ndarray]:
    """The codes 0, 1, 2 and 3 places ahead of every word; a pad behind a piece's end or another pad."""
    columns, n = [codes], len(codes)
    for ahead in range(1, LONGEST):
        column = np.full(n, PAD, np.int64)
        if n > ahead:
            column[:-ahead] = np.where((columns[-1][:-ahead] != PAD) & goes_on[ahead - 1:-1], codes[ahead:], PAD)
        columns.append(column)
    return columns


def _windows(source: DataFrame, blob, name: str, complete: bool) -> DataFrame:
    """key (three codes), last (the fourth code) and n of windows; unless the codebook is ``complete``, also the words spelled out
    among the three, after the language, and the fourth."""
    def emit(key, last, n, *said: list[str]) -> pa.RecordBatch:
        columns = [pa.array(key), pa.array(last.astype(np.int32)), pa.array(n)]
        if not complete:
            columns += [pa.array(s, pa.string()) for s in said or [[""] * len(key)] * 2]
        return pa.RecordBatch.from_arrays(columns, names=["key", "last", "n", *SAID][:len(columns)])

    def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, last = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((last, key))
        key, last = key[order], last[order]
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (last[1:] != last[:-1])])
        return emit(key[first], last[first], np.diff(np.r_[first, len(key)]))

    def spell(words: Words, pairs: list[tuple[str, str]], which: np.ndarray, at: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
        text = words.array
        said, last_said = [], []
        for i, *row in zip(at.tolist(), *(c[at].tolist() for c in columns)):
            own = [text[i + k].as_py() for k in range(3) if row[k] == SPELLED]
            said.append("\n".join([pairs[which[i]][0].encode().hex(), *own]) if own else "")
            last_said.append(text[i + 3].as_py() if row[3] == SPELLED else "")
        key = (columns[0][at] << 2 * CODE_BITS) | (columns[1][at] << CODE_BITS) | columns[2][at]
        return emit(key, columns[3][at], np.ones(len(at), np.int64), said, last_said)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for words, pairs, which in _by_lang(batches):
            codes, other = _codebook(blob, name)[0], PAD if complete else SPELLED
            columns = _lead(np.array([codes.get(p, other) for p in pairs], np.int64)[which], words.goes_on)
            begins = columns[0] != PAD
            if not complete:
                odd = np.logical_or.reduce([c == SPELLED for c in columns])
                if odd.any():
                    yield spell(words, pairs, which, np.flatnonzero(odd), columns)
                begins &= ~odd
            a, b, c, d = (column[begins] for column in columns)
            parts.append(((a << 2 * CODE_BITS) | (b << CODE_BITS) | c, d.astype(np.int32)))
            held += len(a)
            if held >= FLUSH:
                yield counted(parts)
                parts, held = [], 0
        if held:
            yield counted(parts)

    return source.mapInArrow(run, "key bigint, last int, n bigint" + ("" if complete else ", spelled string, last_spelled string"))


def _sums(windows: DataFrame, least: int) -> DataFrame:
    """Sums of each task's windows, with their ``level``: of four and three words those that occur ``least`` times, of two all
    (what this task has of them).

    All windows of three first words are in one task, and a pair's windows in eight at most, however many it has.
    """
    mask, spelled = (1 << CODE_BITS) - 1, "spelled" in windows.columns
    third = F.col("key").bitwiseAND(F.lit(mask).cast("bigint"))
    part = F.pmod(F.xxhash64(third, *(["spelled"] if spelled else [])), F.lit(SPREAD))
    dealt = windows.repartition(F.shiftrightunsigned("key", CODE_BITS), part)
    ordered = dealt.sortWithinPartitions(*(["key", "spelled", "last", "last_spelled"] if spelled else ["key", "last"]))

    def starts(*columns: np.ndarray) -> np.ndarray:
        change = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        return np.flatnonzero(np.r_[True, change])

    def codes(rows: pa.Table, name: str) -> np.ndarray:
        return rows[name].combine_chunks().dictionary_encode().indices.to_numpy() if spelled else np.zeros(len(rows), np.int8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
            if not rest.num_rows:
                continue
            cut = int(starts(rest["key"].to_numpy(), codes(rest, "spelled"))[-1])
            if cut:
                yield summed(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield summed(rest)

    def summed(rows: pa.Table) -> pa.RecordBatch:
        key, last, n = (rows[c].to_numpy() for c in ("key", "last", "n"))
        said = codes(rows, "spelled")
        four, three, two = starts(key, said, last, codes(rows, "last_spelled")), starts(key, said), starts(key >> CODE_BITS, said)
        sums = [np.add.reduceat(n, at) for at in (four, three, two)]
        keep = [(sums[0] >= least) & (last[four] != PAD), (sums[1] >= least) & (key[three] & mask != PAD), np.ones(len(two), bool)]
        at = np.concatenate([a[k] for a, k in zip((four, three, two), keep)])
        level = np.repeat([4, 3, 2], [int(k.sum()) for k in keep])
        texts = rows.select(SAID).take(pa.array(at)).to_pydict() if spelled else {name: [""] * len(at) for name in SAID}
        last_spelled = [text if four else "" for text, four in zip(texts["last_spelled"], (level == 4).tolist())]
        return pa.RecordBatch.from_arrays([
            pa.array(np.where(level == 2, key[at] & ~mask, key[at])), pa.array(texts["spelled"], pa.string()),
            pa.array(np.where(level == 4, last[at], PAD).astype(np.int32)), pa.array(last_spelled, pa.string()),
            pa.array(np.concatenate([s[k] for s, k in zip(sums, keep)])), pa.array(level.astype(np.int32))],
            names=["key", "spelled", "last", "last_spelled", "n", "level"])

    return ordered.mapInArrow(run, "key bigint, spelled string, last int, last_spelled string, n bigint, level int")


def _marginals(sums: DataFrame, least: int) -> DataFrame:
    """The windows and all their prefixes that occur ``least`` times, from the written ``_sums``."""
    mask = F.lit((1 << CODE_BITS) - 1).cast("bigint")
    code = lambda place: F.shiftrightunsigned("key", (2 - place) * CODE_BITS).bitwiseAND(mask)

    def said(places: int) -> Column:
        """The language and the spelled words among the first few."""
        own = sum(((code(i) == SPELLED).cast("int") for i in range(places)), F.lit(0))
        return F.when(own == 0, F.lit("")).otherwise(F.array_join(F.slice(F.split("spelled", "\n"), F.lit(1), own + 1), "\n"))

    pairs = sums.where("level = 2").select(code(0).alias("w0"), said(1).alias("s0"), code(1).alias("w1"), said(2).alias("s1"), "n")
    rolled = sums.sparkSession.sql("SELECT w0, s0, w1, s1, sum(n) AS n FROM {pairs} GROUP BY ROLLUP ((w0, s0), (w1, s1))", pairs=pairs)
    rolled = rolled.where(F.col("w0").isNotNull() & (F.col("n") >= least) & (F.col("w1").isNull() | (F.col("w1") != PAD)))
    key = F.shiftleft("w0", 2 * CODE_BITS).bitwiseOR(F.shiftleft(F.coalesce("w1", F.lit(PAD).cast("bigint")), CODE_BITS))
    short = rolled.select(key.alias("key"), F.coalesce("s1", "s0").alias("spelled"), F.lit(PAD).alias("last"), F.lit("").alias("last_spelled"), "n")
    return sums.where("level > 2").drop("level").unionByName(short)


def _spelled_out(grams: DataFrame, blob, name: str) -> DataFrame:
    """lang, words and n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = _codebook(blob, name)[1]
            langs, phrases = [], []
            for key, spelled, last, last_spelled in zip(*(batch.column(i).to_pylist() for i in range(4))):
                codes = [key >> 2 * CODE_BITS, key >> CODE_BITS & SPELLED, key & SPELLED]
                lang, *own = spelled.split("\n")
                own = iter(own)
                words = [next(own) if c == SPELLED else entries[c - 1][1] for c in codes if c != PAD]
                if last != PAD:
                    words.append(last_spelled if last == SPELLED else entries[last - 1][1])
                known = next((c for c in codes if c not in (PAD, SPELLED)), None)
                langs.append(entries[known - 1][0] if known else bytes.fromhex(lang).decode())
                phrases.append(words)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.list_(pa.string())), batch.column(4)], names=["lang", "words", "n"])

    return grams.mapInArrow(run, "lang string, words array<string>, n bigint")


def phrase_counts(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang",
                  most_codes: int = MOST_CODES) -> tuple[DataFrame, DataFrame]:
    """(lang, words, n of every phrase of one to four words that occurs ``least`` times in a language; lang, n of all words).

    Both are written tables. The codebook of at most ``most_codes`` words is what reaches the driver.
    """
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).where("text <> ''")
    vocabulary = _vocabulary(source, least)
    words = vocabulary.where("word IS NOT NULL")
    book = words.orderBy(F.desc("n"), "lang", "word").limit(most_codes).select("lang", "word").toArrow()
    complete = book.num_rows < most_codes
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, book.schema) as out:
        out.write_table(book)
    blob = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
    name = uuid.uuid4().hex
    spark = docs.sparkSession
    path = fresh_path(spark, "window-sums")
    _sums(_windows(source, blob, name, complete), least).write.parquet(path)
    grams = checkpointed(_spelled_out(_marginals(spark.read.parquet(path), least), blob, name))
    remove_path(spark, path)
    return grams, vocabulary.where("word IS NULL").select("lang", "n")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, text_col: str = "text", lang_col: str = "lang",
                 most_codes: int = MOST_CODES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of every language.

    A-Z count as a-z. Texts are cut into pieces at line breaks and ``.,;:!?``, pieces into words at spaces and tabs. A null
    text counts as empty, a null language as ``und``; repeated rows count as often as they occur; an empty table, or one
    without words, gives no rows. Other columns are not read.

    A candidate is a phrase of two to four words that occurs a >= ``least`` times. Cut in two, its parts occur l and
    r times, overlaps included; the score is floor(2000000 a / (l + r)) of the cut that scores least (of equals the first).
    A candidate inside a longer one that occurs ``covered`` percent as often or more is left out. n counts the words of the
    language. Ranks go by score, then a, both falling, then by phrase in order of its bytes. The arithmetic is
    decimal, so it is exact.
    """
    grams, totals = phrase_counts(docs, least, text_col, lang_col, most_codes)
    spoken = lambda words: F.array_join(words, " ")
    counts = grams.select("lang", spoken("words").alias("phrase"), F.col("n").alias("f"))
    several = grams.where(F.size("words") >= 2).select("lang", spoken("words").alias("phrase"), "words", F.col("n").alias("a"))
    cuts = several.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", spoken(F.slice("words", F.lit(1), F.col("k"))).alias("first"),
                       spoken(F.slice("words", F.col("k") + 1, F.lit(LONGEST))).alias("rest"))
    parted = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    parted = parted.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    lowest = parted.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    places = F.expr("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))")
    inner = several.where(F.size("words") >= 3).select("lang", F.explode(places).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = lowest.join(longer, ["lang", "phrase"], "left").where(
        "most IS NULL OR CAST(most AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * " + str(int(covered)))
    found = checkpointed(left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # First the best of every block of candidates, then the best of these.
    block = F.pmod(F.xxhash64("phrase"), F.lit(-(-found.count() // BLOCK_ROWS) or 1))
    few = found.withColumn("block", block).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "block").orderBy(*order)))
    few = few.where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATION_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), sequences AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM sequences
), grams AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, any_value(w[i:i + m - 1]) AS words, count(*) AS f
    FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE i + m - 1 <= len(w) GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT * FROM grams WHERE m >= 2 AND f >= 30
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
           CAST((CAST(c.f AS HUGEINT) * 2000000) // (x.f + y.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:k], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1:], ' ')
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, array_to_string(words[s:s + d - 1], ' ') AS phrase, max(f) AS most
    FROM (SELECT *, unnest(range(1, m)) AS s FROM candidates), (VALUES (2), (3)) AS lengths(d)
    WHERE d < m AND s + d - 1 <= m GROUP BY ALL
)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank, c.phrase, a, l, r, n, score
FROM lowest c JOIN totals USING (lang) LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
WHERE most IS NULL OR 100 * most < 80 * a
QUALIFY rank <= 2000
"""
