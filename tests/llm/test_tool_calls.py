import json
import random

import pytest
from pyspark.sql import functions as F

from candor.llm import tool_calls as T

CALLS = "conv_id LONG, turn LONG, call_id STRING, tool STRING, arguments STRING, after STRING"
RESULTS = "conv_id LONG, turn LONG, call_id STRING, content STRING"


def run(spark, calls, results):
    c = spark.createDataFrame(calls, CALLS).withColumn("depth", F.lit("x")).withColumn("ord", F.lit(1)).withColumn("h", F.lit(1))
    return T.link_calls(c, spark.createDataFrame(results, RESULTS).withColumn("r", F.lit(1)).withColumn("n_results", F.lit(9)), T.SCHEMAS).collect()


def test_depths_of_random_forests_and_cycles(spark):
    rng = random.Random(1)
    nodes, want = [], {}
    for conv in range(30):
        ids = [f"n{i}" for i in range(25)]
        rng.shuffle(ids)
        up = {x: (rng.choice(ids[:k]) if k and rng.random() < 0.9 else None) for k, x in enumerate(ids)}
        if conv % 3 == 0:
            up[ids[3]] = ids[7]
            up[ids[7]] = ids[3]
        for x in ids:
            path, y = [], x
            while y is not None and y not in path:
                path.append(y)
                y = up[y]
            want[conv, x] = len(path) - 1 if y is None else None
            nodes.append((conv, x, up[x]))
    nodes += [(99, f"c{i}", f"c{i - 1}" if i else None) for i in range(300)]
    want |= {(99, f"c{i}"): i for i in range(300)}
    got = T.depths(spark.createDataFrame(nodes, "conv_id LONG, call_id STRING, after STRING"))
    assert {(r.conv_id, r.call_id): r.depth for r in got.collect()} == want


def test_links_order_and_status(spark):
    good = '{"limit": 3, "query": "é\\n\\"x\\""}'
    calls = [
        (1, 5, "b", "search", good, "a"), (1, 7, "a", "lookup", '{"key":"k"}', None), (1, 9, "c", "search", '{"query": 1}', "b"),
        (1, 11, "d", "shell", "{}", "zz"), (1, 12, "e", "calc", '{"values":[1.50,2],"unit":"m"}', "zz"), (1, 13, "f", "calc", "{", None),
        (1, 14, "g", "calc", '{"values":[]}', "h"), (1, 15, "h", "calc", '{"values":[]}', "g"), (1, 16, "a", "lookup", '{"key":"again"}', "c"),
        (1, 17, None, "lookup", '{"key":"k"}', None), (None, 1, "x", "lookup", '{"key":"k"}', None), (2, 1, "a", "lookup", '{"key":"k"}', None),
        (3, 1, "s", "lookup", '{"key":"k"}', None), (3, 1, "s", "lookup", '{"key":"k"}', None), (3, None, "t", "lookup", None, None)]
    results = [(1, 6, "b", "late"), (1, 5, "b", "first"), (1, 8, "a", None), (1, 8, "nobody", "x"), (None, 1, "x", "y"), (3, 2, "s", "z" * 100000), (1, 9, None, "q")]
    got = run(spark, calls, results)
    assert len(got) == len(calls)
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.call_id), []).append(r)
    status = {k: sorted(r.status for r in v) for k, v in by.items()}
    assert status == {
        (1, "a"): ["duplicate_id", "ok"], (1, "b"): ["ok"], (1, "c"): ["invalid_arguments"], (1, "d"): ["unknown_tool"], (1, "e"): ["unknown_dependency"],
        (1, "f"): ["invalid_json"], (1, "g"): ["cycle"], (1, "h"): ["cycle"], (1, None): ["missing_id"], (None, "x"): ["missing_id"], (2, "a"): ["no_result"],
        (3, "s"): ["duplicate_id", "ok"], (3, "t"): ["invalid_json"]}
    b = by[1, "b"][0]
    assert b.message == '{"arguments":{"limit":3,"query":"é\\n\\"x\\""},"id":"b","name":"search","result":"first"}' and b.n_results == 2
    assert json.loads(by[1, "a"][0].message)["result"] == "" and by[2, "a"][0].message.endswith('"result":null}')
    order = [r.call_id for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.ord)]
    assert [r.ord for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.ord)] == list(range(1, 11))
    assert order[:6] == ["a", "d", "e", "f", "b", "c"] and set(order[6:]) == {"g", "h", "a", None}
    orphans = T.orphan_results(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)).collect()
    assert sorted(str(r.call_id) for r in orphans) == ["None", "nobody", "x"]


def test_empty(spark):
    assert run(spark, [], []) == []
    assert [r.status for r in run(spark, [(1, 1, "a", "lookup", '{"key":""}', None)], [])] == ["no_result"]


@pytest.mark.parametrize(("text", "problem"), [
    ('{"query":"a","query":"b"}', "invalid_json"), ('{"query":NaN}', "invalid_json"), ("[1]", "invalid_arguments"), ('{"query":"a","limit":true}', "invalid_arguments"),
    ('{"query":"a","limit":1.0}', "invalid_arguments"), ('{"query":"a","extra":1}', "invalid_arguments"), ('{"query":"\\ud800"}', "invalid_json"), ("", "invalid_json"),
    ("[" * 100000, "invalid_json"), (None, "invalid_json"), ('{"query":"a"}', "")])
def test_arguments(text, problem):
    assert T.check_arguments(text, T.SCHEMAS["search"])[0] == problem


def test_canonical_form():
    assert T.check_arguments(' {"b": [1, 2.50, true, null], "a": {"d": "é/", "c": ""}} ', None)[1] == '{"a":{"c":"","d":"é/"},"b":[1,2.5,true,null]}'
