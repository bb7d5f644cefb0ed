"""Schema inference against a plain statement of what a path's type and presence are."""

import collections
import json

from lakelens.operators import schemas

NAMES = {dict: "object", list: "array", str: "string", bool: "bool", int: "int", float: "float"}


def holders(doc, path):
    """The objects that could hold the last key of ``path``, or None where a value on the
    way is missing, plain or an empty list."""
    found = [doc] if isinstance(doc, dict) else [None]
    for key in path[:-1]:
        values = [None if h is None else h.get(key) for h in found]
        found = [x for v in values for x in ([v] if isinstance(v, dict) else [i for i in v if isinstance(i, dict)] if isinstance(v, list) and v else [None])]
    return found


def values_of(doc, at=()):
    if isinstance(doc, dict):
        for key, value in doc.items():
            if value is not None:
                yield (*at, key), NAMES[type(value)]
            for item in value if isinstance(value, list) else [value]:
                if isinstance(item, dict):
                    yield from values_of(item, (*at, key))


def by_hand(texts):
    docs = []
    for t in texts:
        try:
            docs.append(json.loads(t))
        except (TypeError, ValueError):
            docs.append(None)
    seen = collections.defaultdict(list)
    for doc in docs:
        for path, kind in values_of(doc):
            seen[path].append(kind)
    out = {}
    for path, kinds in seen.items():
        everywhere = all(h is not None and h.get(path[-1]) is not None for d in docs for h in holders(d, path))
        counts = collections.Counter(kinds)
        kind = "float" if set(kinds) == {"int", "float"} else max(counts, key=lambda k: (counts[k], -kinds.index(k)))
        out[path] = (kind, len(kinds), not everywhere)
    return out


def by_spark(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, doc string").repartition(4)
    return {tuple(r.path): (r.native_type, r.n, r.nullable) for r in schemas.infer_schema(df, "doc", "seq").collect()}


def check(spark, docs):
    texts = [d if d is None or isinstance(d, str) else json.dumps(d) for d in docs]
    assert by_spark(spark, texts) == by_hand(texts)


def test_types_and_presence(spark):
    check(spark, [
        {"a.b": 1, "n": 1, "mix": "x", "tide": {"high": 2.0, "a.b": True}, "ports": [{"id": 1, "sub": {"x": 1}}, {"id": 2, "sub": {"x": 2}}], "ids": [1, 2]},
        {"a.b": 2, "n": 1.5, "mix": 3, "tide": {"high": 12345678901234567890123, "a.b": False}, "ports": [{"id": "q", "sub": {"x": 1}}], "ids": ["z"], "gone": None},
        {"a.b": 3, "n": 1e3, "mix": 4, "tide": {"high": 7, "a.b": True, "low": 0}, "ports": [{"id": 3, "sub": {}}, 5], "ids": []},
    ])


def test_empty_lists_plain_values_and_deep_documents(spark):
    deep = {"k": 1}
    for i in range(11):
        deep = {"d": [deep, {"k": i}]} if i % 2 else {"d": deep}
    check(spark, [deep, {"d": {"d": [{"d": {}}]}}])
    check(spark, [{"p": [{"q": 1}]}, {"p": []}, {"p": [{"q": 2}]}])
    check(spark, [{"p": {"q": 1}}, {"p": 3}])
    check(spark, [{"p": [1, {"q": 1}], "r": [[{"s": 1}]]}])


def test_documents_that_are_none(spark):
    check(spark, [{"a": 1}, "[1]"])
    check(spark, [{"a": 1}, None])
    check(spark, [{"a": 1}, "not json"])
    assert by_spark(spark, []) == {} and by_spark(spark, ["{}", "null"]) == {}


def test_no_python_in_the_plan(spark, capsys):
    schemas.infer_schema(spark.createDataFrame([(1, "{}")], "seq long, doc string"), "doc", "seq").explain()
    assert "Python" not in capsys.readouterr().out
