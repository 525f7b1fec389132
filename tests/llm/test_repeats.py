import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabflow.llm import run_length_index
from tabflow.llm.queries import QUERIES
from tabflow.llm.run_length_index import LENGTH, NO_ID, RunLengthIndex, drop_repeated_bytes, pieces_of, repeated_bytes, window_keys


def plain_removal(rows, length=LENGTH):
    """(id, n_bytes, n_removed, n_spans, sha) of (id, text) rows by a table of all strings."""
    first = {}
    number = lambda i: NO_ID if i is None else i
    for i, t in rows:
        data = (t or "").encode()
        for at in range(len(data) - length + 1):
            s = data[at:at + length]
            first[s] = min(first.get(s, 1 << 62), number(i))
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first[data[at:at + length]] < number(i):
                gone[at:at + length] = b"\1" * length
        rest = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        yield str(i), len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()


def made_up(seed, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(1, 40)))
            parts.append(p[rng.randint(0, 9):] if rng.random() < 0.5 else p)
        rows.append((i * 2, "\n".join(parts)))
    rows += [(1000, "x" * 3000), (1001, "x" * 70 + "y" + "x" * 70), (1002, "ab" * 500), (1003, rows[5][1]), (1004, rows[5][1])]
    return rows


def found(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("block_bytes,hot", [(4 << 20, 200_000), (3000, 200_000), (3000, 3), (1 << 14, 0)])
def test_against_a_table_of_strings(spark, monkeypatch, block_bytes, hot, odd_texts):
    monkeypatch.setattr(run_length_index, "BLOCK_BYTES", block_bytes)
    rows = made_up(block_bytes + hot) + [(2000 + i, t) for i, t in enumerate(odd_texts)]
    rows += [(None, rows[7][1]), (None, "lonely " * 20), (7, rows[9][1]), (7, rows[9][1]), (2999, "Word " * 1000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_removed int").repartition(3)
    assert found(repeated_bytes(df, hot=hot)) == sorted(plain_removal(rows))


def test_texts_left(spark, odd_texts):
    rows = made_up(9, 40) + [(500 + i, t) for i, t in enumerate(odd_texts)] + [(600, None), (None, "z")]
    df = spark.createDataFrame([(i, t, "k", 0) for i, t in rows], "doc_id long, text string, _block string, n_spans int")
    out = drop_repeated_bytes(df)
    assert out.columns == ["doc_id", "text", "_block", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    left = {r.doc_id: r for r in out.collect()}
    assert len(left) == len(rows)
    for i, t in rows:
        if not left[i].n_removed:
            assert left[i].text == t
        elif (t or "").isascii():
            assert hashlib.sha256(left[i].text.encode()).hexdigest() == left[i].kept_sha256
    assert drop_repeated_bytes(df.limit(0)).count() == 0 and repeated_bytes(df.limit(0)).count() == 0


@pytest.mark.parametrize("block_bytes", [4 << 20, 20_000])
def test_a_hot_row_is_cut_once(spark, monkeypatch, block_bytes):
    """Copies of one row beyond a block: the same results, other columns of the copies kept, and no block holds them all."""
    monkeypatch.setattr(run_length_index, "BLOCK_BYTES", block_bytes)
    made = []
    monkeypatch.setattr(run_length_index, "_cut_once", lambda docs, *a, f=run_length_index._cut_once: made.append(docs.count()) or f(docs, *a))
    rows = made_up(4, 40) + [(3, made_up(4, 40)[7][1] + " and more of the like " * 20)] * 300 + [(None, "no id " * 30)] * 200 + [(5, None)] * 400 + [(5, "")] * 2
    df = spark.createDataFrame([(i, t, n, "k") for n, (i, t) in enumerate(rows)], "doc_id long, text string, Kept_SHA256 int, _copy string").repartition(3)
    assert found(repeated_bytes(df)) == sorted(plain_removal(rows))
    assert made == [len(rows) if block_bytes > 1 << 20 else len(set((i, t or "") for i, t in rows))]
    out = drop_repeated_bytes(df)
    assert out.columns == ["doc_id", "text", "_copy", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = out.collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(plain_removal(rows))
    assert sum(r.text is None for r in got) == 400 and all(r.text is None or hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got if r.n_removed)


def test_a_very_long_text(spark):
    rng = random.Random(3)
    line = " ".join(str(rng.random()) for _ in range(200_000))
    rows = [(1, line[1000:40_000]), (2, line), (3, "short"), (4, "tail" + line[-500:])]
    got = {r.doc_id: r for r in repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 39_000 and got[2].n_spans == 1 and got[4].n_removed == 500 and got[3].n_bytes == 5


def test_texts_alike_by_chance_are_not_sent():
    """Documents of common words share many strings of 16 bytes, and hardly one of 50: their pieces stay in their blocks."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=10)) for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(150)]
    strings = [{t[at:at + 16] for at in range(len(t) - 15)} for t in texts]
    seen = Counter(s for some in strings for s in some)
    assert sum(n for n in seen.values() if n > 1) > 0.4 * sum(seen.values())
    repeated = " ".join(rng.choices(words, k=40))
    texts[100] += repeated
    texts[20] = repeated + texts[20]
    halves = [pa.table({"doc_id": range(lo, lo + 75), "text": texts[lo:lo + 75]}) for lo in (0, 75)]
    blocks = [run_length_index.Block(half, "doc_id", "text", 1, LENGTH) for half in halves]
    told = [(i, b, k.tobytes(), n.tobytes()) for i, block in enumerate(blocks) for b, k, n in block.anchors()]
    marked = run_length_index._mark(pa.table(dict(zip(("block", "bucket", "keys", "told"), map(list, zip(*told))))), 200_000)
    for block, codes in zip(blocks, marked["codes"].to_pylist()):
        block.shared({0: codes})
        assert 0 < len(block.place) < 0.1 * len(block.at)
        assert block.size.sum() >= len(repeated) - LENGTH + 1


def test_anchors_that_agree_in_what_is_told(spark, monkeypatch):
    """One byte of an anchor is told, so that most share it with others: more is sent, and the result is the same."""
    monkeypatch.setattr(run_length_index, "KEY_BYTES", 1)
    rows = made_up(8, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for hot in (200_000, 30):
        assert found(repeated_bytes(df, hot=hot)) == sorted(plain_removal(rows))


def test_pieces_hold_every_window_once():
    rng = np.random.default_rng(0)
    sizes = [0, 49, 50, 51, 0, 400, 90]
    data = rng.integers(97, 101, sum(sizes)).astype(np.uint8)
    starts = np.r_[0, np.cumsum(sizes)]
    key, at, windows, text = pieces_of(data, starts)
    every = [p for a, w in zip(at, windows) for p in range(a, a + w)]
    assert every == [p for d, s in enumerate(sizes) for p in range(starts[d], starts[d] + s - 49)]
    keys = window_keys(data)
    assert all(keys[p] == k for k, a, w in zip(key, at, windows) for p in range(a, a + w))
    assert all(starts[t] <= a and a + w + 49 <= starts[t + 1] for a, w, t in zip(at, windows, text))


def longest(text, pieces, most):
    """How much of the beginning of a text some piece has."""
    n = 0
    while n < min(most, len(text)) and any(text[:n + 1] in piece for piece in pieces):
        n += 1
    return n


@pytest.mark.parametrize("seed", range(12))
def test_matching_statistics(seed):
    """Against the longest match by trial, at every byte; the place found has it."""
    rng = random.Random(seed)
    letters = ["ab", "ab\0\xff", "abcdefgh", "".join(map(chr, range(256)))][seed % 4]
    length = [8, 20, 50][seed % 3]
    base = ["".join(rng.choice(letters) for _ in range(90)).encode("latin-1") for _ in range(3)]
    draw = lambda: rng.choice(base)[rng.randint(0, 30):][:rng.randint(1, 80)] + bytes([rng.choice(letters.encode("latin-1"))]) * rng.randint(0, 3)
    pieces = [draw() for _ in range(25)] + [b"a" * 60, b"a"]
    texts = [draw() + draw() for _ in range(30)] + [b"", b"a" * 100, b"~~~", b"\x80"] + pieces[:3]
    starts = np.r_[0, np.cumsum([len(p) for p in pieces])]
    index = RunLengthIndex.build(np.frombuffer(b"".join(pieces), np.uint8), starts, length)
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    found, place = index.statistics(data, np.cumsum(sizes) - sizes, sizes, length)
    want = [longest(t[i:], pieces, length) for t in texts for i in range(len(t))]
    assert found.tolist() == want
    bytes_of = np.zeros(257, int)
    bytes_of[index.code] = np.arange(256)
    for (t, i), n, at in zip(((t, i) for t in texts for i in range(len(t))), found, place):
        assert bytes(bytes_of[index.text[at:at + n]].astype(np.uint8)) == t[i:i + n]
    assert len(index.first) == len(index.at_first) == len(index.by_byte) <= len(index.text)


@pytest.mark.parametrize("rounds", [0, 1, 8])
@pytest.mark.parametrize("length", [32, 50])
def test_least_ids(monkeypatch, rounds, length):
    """Pieces of few anchors in many variants, so that several rounds are needed."""
    monkeypatch.setattr(run_length_index, "ROUNDS", rounds)
    monkeypatch.setattr(run_length_index, "PIECES_AT_ONCE", 40)
    rng = random.Random(length + rounds)
    data = bytearray()
    for _ in range(4):
        core = "".join(rng.choice("abcdef") for _ in range(40))
        for _ in range(60):
            left, right = ("".join(rng.choice("xy") for _ in range(rng.randint(0, 30))) for _ in range(2))
            data += (left + core + right).encode() + b"." * rng.randint(0, 20) + "".join(rng.choice("pqrs") for _ in range(30)).encode()
    data = np.frombuffer(bytes(data), np.uint8)
    key, at, windows, _ = pieces_of(data, np.r_[0, len(data)], length)
    text = data[run_length_index.spread(at, windows + length - 1)]
    starts = np.r_[0, np.cumsum(windows + length - 1)]
    owner = np.array([rng.randint(0, 50) for _ in at])
    strings = [text[a + i:a + i + length].tobytes() for a, w in zip(starts, windows) for i in range(w)]
    least = {}
    for string, o in zip(strings, np.repeat(owner, windows).tolist()):
        least[string] = min(o, least.get(string, o))
    assert len(least) < len(strings)
    assert run_length_index.least_ids(text, starts, owner, length).tolist() == [least[x] for x in strings]


def test_rows_between_blocks_and_buckets_grow_with_the_text():
    """Eight times the text has eight times the rows, not sixty-four times."""
    def rows(size):
        buckets = -(-size // run_length_index.BUCKET_BYTES)
        return buckets * -(-size // run_length_index.block_bytes(buckets))

    assert run_length_index.block_bytes(1) == run_length_index.BLOCK_BYTES
    assert 7.5 < rows(160 << 30) / rows(20 << 30) < 8.5
    assert run_length_index.block_bytes(10 ** 9) == run_length_index.MOST_BLOCK_BYTES


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(QUERIES["op7_suffix_array_dedup"](spark, sf_dir)) == sorted(plain_removal(rows))
