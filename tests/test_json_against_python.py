"""Random and damaged JSON lines: the parser must accept and read what ``json.loads`` does."""

import json
import random
import re

import pytest

from tabflow.functions.schema import schema_from_text
from tabflow.operators.parse import REASON, parse_object, tag_csv, tag_json, tag_object

NAMES = ["a", "b", "c"]
SCHEMA = schema_from_text("a:STRING, b:STRING, c:STRING")
CORNERS = [
    '{"a":"1","a":"2"}', '{"a":"\x01"}', '{"a":01}', '{"a":1.}', '{"a":.5}', '{"a":+1}', "{a:1}", '{"a":1,}',
    '[{"a":1}]', '[{"a":1},]', '{"a":1}//c', '/*c*/{"a":1}', '{"a":1e5}', '{"a":"\\x41"}', '{"a":1}]', "{}]",
    '{"a":1}],[{}', '{"a":1},{"a":2}', '{"a":1}{"a":2}', '{"a":1}}', "{'a':1}", "", " ", "null", "3", '"a"', "{}",
    '{"a":[1,"b":]}', '{"a":"\\u00"}', '{"a":1,"b":"x","c":[1 2]}', '{"a":1,"b":2,"c":3,"d":[1 2]}',
    '{"a":1,"b":2,"c":3}x', '{"a":{"b":[{}]},"b":"☃","c":true}', '\t{"a":1,"b":2,"c":3}\r', '{"a":1,"b":2,"c":3',
]


def _value(rnd):
    return rnd.choice([
        rnd.randint(-10**6, 10**6), rnd.random() * 1e3, None, True, False, "x" * rnd.randint(0, 4),
        'é"\\\n\t☃', [1, "a"], {"k": 1}, str(rnd.randint(0, 99)), 10**25, "",
    ])


def _damage(rnd, text):
    if rnd.random() < 0.5:
        return text
    at = rnd.randrange(len(text) + 1)
    return rnd.choice([
        text[:at] + text[at + 1:], text[:at] + rnd.choice('{}[],:"\' x1\\\n\t') + text[at:], text + text, text[:at],
        f" {text}  \r", text + rnd.choice("]},x "),
    ])


def _lines():
    rnd = random.Random(11)
    objects = ({k: _value(rnd) for k in rnd.sample([*NAMES, "d"], rnd.randint(0, 4))} for _ in range(6000))
    return [_damage(rnd, json.dumps(o, ensure_ascii=rnd.random() < 0.5)) for o in objects] + CORNERS


def _loads(text):
    def refuse(name):
        raise ValueError(name)  # NaN and Infinity are not JSON

    try:
        found = json.loads(text, parse_constant=refuse)
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def _beyond_a_double(text):
    """A number of more digits than a double holds: a reject, not a rounded value."""
    return any(len(n.replace(".", "").strip("0")) > 17 for n in re.findall(r"\d+\.\d+", text))


def _same(value, read):
    if value is None or read is None:
        return value is None and read is None
    if isinstance(value, str):
        return value == read
    return json.loads(read) == value


@pytest.mark.parametrize("require_keys", [False, True])
@pytest.mark.parametrize("allow_extra_keys", [False, True])
def test_like_json_loads(spark, require_keys, allow_extra_keys):
    texts = _lines()
    df = spark.createDataFrame(list(enumerate(texts)), "i long, value string")
    tagged = tag_json(df, SCHEMA, require_keys=require_keys, allow_extra_keys=allow_extra_keys, keep=["i"])
    rows = {r["i"]: r for r in tagged.collect()}
    assert len(rows) == len(texts)
    wrong = []
    for i, text in enumerate(texts):
        wanted, row = _loads(text), rows[i]
        if wanted is None:
            ok = row[REASON] == "malformed"
        elif require_keys and set(NAMES) - set(wanted):
            ok = row[REASON] == "missing " + ",".join(n for n in NAMES if n not in wanted)
        elif not allow_extra_keys and set(wanted) - set(NAMES):
            ok = row[REASON] == "unknown " + ",".join(n for n in wanted if n not in NAMES)
        else:
            ok = row[REASON] is None and all(_same(wanted.get(n), row[n]) for n in NAMES)
        if not ok and not (_beyond_a_double(text) and (row[REASON] or "").startswith("bad value")):
            wrong.append((text, row[REASON]))
    assert not wrong


def test_objects_like_json_loads(spark):
    """The parse of routed messages, and the rows made of it."""
    texts = _lines()
    df = spark.createDataFrame(list(enumerate(texts)), "i long, value string")
    rows = {r["i"]: r for r in tag_object(parse_object(df, keep=["i"]), SCHEMA, keep=["i"]).collect()}
    assert len(rows) == len(texts)
    wrong = []
    for i, text in enumerate(texts):
        wanted, row = _loads(text), rows[i]
        if wanted is None:
            ok = row[REASON] == "malformed"
        elif set(wanted) - set(NAMES):
            ok = row[REASON] == "unknown " + ",".join(n for n in wanted if n not in NAMES)
        else:
            ok = row[REASON] is None and all(_same(wanted.get(n), row[n]) for n in NAMES)
        if not ok and not (_beyond_a_double(text) and (row[REASON] or "").startswith("bad value")):
            wrong.append((text, row[REASON]))
    assert not wrong


def test_csv_like_split(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(',,,ab"\' \t1☃') for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, value string")
    for row in tag_csv(df, SCHEMA, keep=["i"]).collect():
        fields = (texts[row["i"]].split(",") + [None] * 3)[:3]
        assert [row[n] for n in NAMES] == fields and row[REASON] is None
