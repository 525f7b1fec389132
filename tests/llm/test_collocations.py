import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from check import compare, connect  # noqa: E402
from tabflow.llm.collocations import COLLOCATION_SQL, collocations  # noqa: E402
from tabflow.llm.queries import QUERIES  # noqa: E402

SCHEMA = "text string, lang string, Phrase string, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top, covered=80):
    """Every phrase counted by itself."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for i in range(len(words)):
                total[lang or "und"] += 1
                for m in range(1, 5):
                    if i + m <= len(words):
                        counts[lang or "und"][tuple(words[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        several = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in several.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    most[p[i:i + m]] = max(most[p[i:i + m]], a)
        scored = []
        for p, a in several.items():
            if 100 * most[p] >= covered * a:
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def made_up(seed):
    draw = random.Random(seed)
    words = ["The", "the", "of", "é", "ÉTÉ", "a-b", "x y", " ", "zz", "\U0001f600", "nul\x00", "Q"]
    rows = []
    for i in range(300):
        text = "".join(draw.choice(words[:draw.randrange(2, 13)]) + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\r\n", "\x0b", " :"])
                       for _ in range(draw.randrange(0, 60)))
        rows.append((text, draw.choice(["en", "fr", None, "und", "l\nx"]), "clash", 1))
    return rows


@pytest.mark.parametrize("seed, least, top, codes", [(1, 2, 2000, 1_000_000), (1, 2, 2000, 7), (2, 3, 10, 1_000_000), (3, 5, 4, 0), (4, 1, 50, 20)])
def test_against_every_phrase_counted(spark, odd_texts, seed, least, top, codes):
    rows = made_up(seed) + [(t, lang, "", 0) for t in odd_texts for lang in ("en", None)] + [("same row again and again", "en", "", 0)] * 50
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in collocations(df, least, top, most_codes=codes).collect())
    want = plain(rows, least, top)
    assert len(want) > 15
    assert got == want


def test_blocks_of_candidates(spark, monkeypatch):
    monkeypatch.setattr("tabflow.llm.collocations.BLOCK_ROWS", 3)
    monkeypatch.setattr("tabflow.llm.collocations.FLUSH", 10)
    rows = made_up(5)
    got = sorted(tuple(r) for r in collocations(spark.createDataFrame(rows, SCHEMA), 2, 5).collect())
    assert got == plain(rows, 2, 5)


def test_very_long_text_and_one_language(spark):
    rows = [("alpha beta gamma delta " * 300_000, "en", "", 0), ("alpha beta", "en", "", 0)]
    assert sorted(tuple(r) for r in collocations(spark.createDataFrame(rows, SCHEMA)).collect()) == plain(rows, 30, 2000)


def test_empty(spark):
    for rows in ([], [(None, None, "", 0), ("", "en", "", 0), (" .\n", "en", "", 0)]):
        out = collocations(spark.createDataFrame(rows, SCHEMA))
        assert out.collect() == [] and out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_registered_query_against_sql(spark, sf_dir):
    assert compare(QUERIES["op12_phrase_collocations"](spark, sf_dir), connect(sf_dir), COLLOCATION_SQL) is None
