import json

from tidewright.operators import nested as n

CH = [n.Child("line", "lines", "id"), n.Child("dx", "dx", "code")]
X12 = [n.Child("segment", "segments", "_segment", "claim_seq")]


def brute(text, children):
    def opened(v):
        if isinstance(v, str):
            try:
                v = json.loads(v)
            except ValueError:
                return []
        return v if isinstance(v, list) else [v] if isinstance(v, dict) else []

    try:
        roots = [r for r in opened(json.loads(text)) if isinstance(r, dict)] if text is not None else []
        top = opened(json.loads(text)) if text is not None else []
    except ValueError:
        return []
    out = []
    for c in children:
        for items in [top] if not c.path else [opened(r.get(c.path)) for r in roots]:
            for i, e in enumerate(items):
                if isinstance(e, dict):
                    out.append((c.name, int(e.get(c.parent) or 0) if c.parent else 0, i, "" if e.get(c.key) is None else str(e[c.key])))
    return out


TEXTS = [
    None, "", " ", "null", "7", '"x"', "[]", "{}", '{"lines":[{"id":"a"},null,{"id":null},3,{}],"dx":{"code":"c"}}', '{"lines":"[{\\"id\\":\\"q\\"}]","dx":"broken["}', '"{\\"lines\\":[{\\"id\\":1}]}"',
    '[{"lines":[{"id":"a"}]},null,{"lines":[{"id":"b"}],"dx":[{"code":"z"}]}]', '{"lines":[{"id":"a"}]} x', '{"lines":[{"id":"a"}]},{"lines":[]}', '{"lines":[{"id":"a"}]}]', '{"lines":[{"id":"a"}', ' {"lines" : [ {"id" : "é\\n"} ] } ', '{"lines":"\\"[1]\\""}', json.dumps({"lines": [{"id": str(i), "x": "y" * 50} for i in range(3000)]}),
]


def test_forms(spark, rows):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(TEXTS)], "k long, t string, child string, pos int")
    got = rows(n.explode_children(df, "k", "t", CH).drop("object"))
    assert got == sorted([(str(i), *r) for i, t in enumerate(TEXTS) for r in brute(t, CH)], key=repr)
    assert rows(n.explode_children(df.limit(0), "k", "t", CH).drop("object")) == []


def test_roots_as_the_collection_and_parents(spark, rows):
    texts = ['[{"z":"012"},null,{"z":5}]', '{"z":null}', '"{\\"z\\":\\"1\\"}"', "[[1]]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, t string")
    c = [n.Child("demo", "", "z")]
    assert rows(n.explode_children(df, "k", "t", c).drop("object")) == sorted([(str(i), *r) for i, t in enumerate(texts) for r in brute(t, c)], key=repr)
    segs = ['{"segments":[{"_segment":"ISA","claim_seq":0},{"_segment":"CLM","claim_seq":"2"},{"01":"x","claim_seq":{"a":1}},{"_segment":{"a":1}}]}']
    got = rows(n.explode_children(spark.createDataFrame([(1, segs[0])], "k long, t string"), "k", "t", X12).drop("object"))
    assert got == [("1", "segment", 0, 0, "ISA"), ("1", "segment", 0, 2, ""), ("1", "segment", 0, 3, '{"a":1}'), ("1", "segment", 2, 1, "CLM")]


def test_typed_table(spark, rows):
    df = spark.createDataFrame([(1, '{"lines":[{"id":"a","n":"2","d":"2024-02-30"},{"id":"b","n":"x"}]}')], "k long, t string")
    assert rows(n.child_table(df, "k", "t", CH[0], {"n": "int", "d": "date"})) == [("1", 0, 0, "a", 2, None), ("1", 0, 1, "b", None, None)]
