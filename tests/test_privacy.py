import json

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwork.functions import fields, json_index
from tillwork.operators.privacy import Rule, pseudonymise_json

EMAIL, PHONE = Rule("doc", "email", "email", ("contact", "email")), Rule("doc", "phone", "phone", ("others", "*", "phone"))


def run(spark, *docs, rules=(EMAIL, PHONE)):
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    hashed, lookup = pseudonymise_json(df, list(rules), "s")
    return [r.doc for r in hashed.orderBy("id").collect()], sorted(tuple(r) for r in lookup.collect())


def json_places(text, paths):
    """The places in one text, with neighbours that must not matter."""
    found = json_index.json_places(pa.array(['{"a":[1],"b":"\\\\"}', text, None, '"\\""']), paths).to_pylist()
    assert found[2] is None
    return found[1]


def digest(spark, value):
    return spark.range(1).select(fields.salted_hash(F.lit(value), "s")).first()[0]


def test_only_the_values_change(spark):
    text = ' {"x" : 1.10, "big":12345678901234567890.12,"none":null, "x":"two \\u00e9 \U0001f600", "contact":{"email":"A@mail.com","z":[{}]},"others":[{"phone":"bad"},[],{"phone":null},3]} '
    docs, lookup = run(spark, text, None, "{}", '"text"', '{"contact":"none"}')
    want = text.replace('"A@mail.com"', f'"{digest(spark, "a@mail.com")}"').replace('"bad"', "null")
    assert docs == [want, None, "{}", '"text"', '{"contact":"none"}']
    assert lookup == [("a@mail.com", digest(spark, "a@mail.com"), "email")]


@pytest.mark.parametrize("text", ["", " ", "]", "{]", "[}", "[1,]", "[,1]", "{,}", '{"a":}', '{"a"}', '{"a":1 "b":2}', '{1:2}', '{"a":1:2}', '["a":1]', "1 2", '"a" "b"', "01", "1.", "-", "+1", "tru", '"\\x"', '"\\u12g4"', '"\\u123"', '"a\nb"', '"\t"', "\\", '"\\', '"\\"', ":", ",", '{"a":[}]', "\u00a01", "[1]]", "[[1]", '{"a":1}}', "{", '{"a":1,}', '{"a" 1}', "{'a':1}", "[1 2]", '{"a":NaN}', "{} {}", '{"contact":{"email":"x}', "nul"])
def test_malformed_documents_fail(spark, text):
    with pytest.raises(ValueError):
        json_places(text, [("contact", "email"), ("others", "*", "phone")])
    with pytest.raises(Exception):
        run(spark, text)


def test_values_that_are_no_text(spark):
    docs, lookup = run(spark, '{"n":[12.50,true,null,"t"]}', rules=[Rule("doc", "n", None, ("n", "*"))])
    assert [x[0] for x in lookup] == ["12.50", "t", "true"] and json.loads(docs[0])["n"][2] is None


def test_two_rules_of_one_path_are_refused(spark):
    with pytest.raises(ValueError):
        run(spark, "{}", rules=[EMAIL, EMAIL])


json_values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["a", "b", "\u00e9", 'q"']), inner, max_size=3), max_leaves=12,
)


@settings(max_examples=150, deadline=None)
@given(json_values, st.sampled_from([None, 1]), st.booleans())
def test_places_agree_with_the_parsed_tree(tree, indent, ascii_only):
    text = json.dumps(tree, indent=indent, ensure_ascii=ascii_only)
    found = json_places(text, [("a", "*"), ("b",), ()] if not isinstance(tree, (dict, list)) else [("a", "*"), ("b",)])
    want = []
    if isinstance(tree, dict):
        for key, node in tree.items():
            if key == "a" and isinstance(node, list):
                want += [x for x in node if x is not None]
            if key == "b" and node is not None:
                want.append(node)
    elif not isinstance(tree, list) and tree is not None:
        want.append(tree)
    assert [json.loads(text[f["start"] : f["stop"]]) for f in found] == want
    assert [f["value"] for f in found if isinstance(json.loads(text[f["start"] : f["stop"]]), str)] == [w for w in want if isinstance(w, str)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list('{}[],:" 1\\u') + ['"a"', "null", "-0.5e3", '"\\u00e9"', "\n"]), max_size=9).map("".join))
def test_accepts_what_a_parser_accepts(text):
    def refuse(word):
        raise ValueError(word)

    try:
        json.loads(text, parse_constant=refuse)
        good = True
    except ValueError:
        good = False
    if good:
        json_places(text, [("a",)])
    else:
        with pytest.raises(ValueError):
            json_places(text, [("a",)])


def walk(node, wanted):
    inner = [(r, p) for r, p in wanted if p]
    if inner and isinstance(node, (dict, list)):
        steps = list(node.items()) if isinstance(node, dict) else [("*", x) for x in node]
        return [x for name, child in steps for x in walk(child, [(r, p[1:]) for r, p in inner if p[0] == name])]
    return [(r, node) for r, p in wanted if not p and node is not None]


@settings(max_examples=200, deadline=None)
@given(st.lists(json_values, min_size=1, max_size=4), st.lists(st.lists(st.sampled_from(["a", "b", "*", "\u00e9", 'q"']), max_size=3).map(tuple), min_size=1, max_size=3, unique=True), st.sampled_from([1, 20, 10**6]))
def test_batches_agree_with_the_parsed_trees(trees, paths, limit):
    texts = [json.dumps(t, ensure_ascii=i % 2 == 0, indent=[None, 1][i // 2 % 2]) for i, t in enumerate(trees)]
    for text, tree, found in zip(texts, trees, json_index.json_places(pa.array(texts), paths, limit).to_pylist()):
        want = walk(tree, list(enumerate(paths)))
        assert [(f["rule"], json.loads(text[f["start"] : f["stop"]])) for f in found] == want


def test_deep_nesting():
    deep = "[" * 200_000 + '{"a":"x"}' + "]" * 200_000
    assert json_places(deep, [("a",)]) == [] and json_places('{"a":' + deep + "}", [("a",)])[0]["stop"] == len(deep) + 5
    with pytest.raises(ValueError):
        json_places(deep + "]", [("a",)])


def test_empty_batch():
    assert json_index.json_places(pa.array([], pa.string()), [("a",)]).to_pylist() == []
    assert json_index.json_places(pa.array([None, None], pa.string()), [("a",)]).to_pylist() == [None, None]
