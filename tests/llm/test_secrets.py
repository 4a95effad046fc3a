import random

from pyspark.sql import functions as F

from lumbung.llm import secrets as sx

SCHEMA = "doc_id long, text string, value string, label int"


def corpus(n=240):
    rng = random.Random(3)
    hexa, base = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rows, truth = [], {}
    for i in range(n):
        ws = [rng.choice(["the", "house", "und", "avec", "running"]) for _ in range(rng.randint(4, 40))]
        kind, secret = i % 8, None
        if kind == 0:
            secret = "".join(rng.choices(hexa, k=18))
            ws[2] = f"password={secret}"
        elif kind == 1:
            secret = "".join(rng.choices(hexa, k=40))
            ws[2] = f'token = "{secret}"'
        elif kind == 2:
            secret = "AKIA" + "".join(rng.choices(base, k=16))
            ws[2] = secret + rng.choice([" ", ", ", "."])
        elif kind == 3:
            ws[2] = "".join(rng.choices("0123456789", k=16))
        elif kind == 4:
            ws[2] = "https://www.example.com/index/file2.html"
        elif kind == 5:
            ws[2] = "the-running-house-and-the-test-2"
        rows.append((i, " ".join(ws), "x", 1))
        truth[i] = secret
    return rows, truth


def test_findings_and_redaction(spark):
    rows, truth = corpus()
    rows += [(900, None, "x", 1), (901, "", "x", 1), (0, rows[0][1], "x", 1), (None, rows[1][1], "x", 1), (902, "word " * 40000 + rows[2][1], "x", 1)]
    truth[902] = truth[2]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in sx.scan(df).collect()}
    for doc, secret in truth.items():
        assert [x.value for x in got[doc].secrets] == ([secret] if secret else []), rows[doc][1] if doc < 900 else doc
        assert got[doc].n_candidates == got[doc].n_secrets + got[doc].n_rejected
    assert got[900].n_candidates == got[901].n_candidates == 0
    out = sx.redact(df).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"doc_id", "text", "value", "label"}
    for r in out:
        secret = truth.get(r.doc_id)
        original = next((t for d, t, *_ in rows if d == r.doc_id))
        assert r.text == (original.replace(secret or truth[1], sx.SECRET) if secret or r.doc_id is None else original)


def test_expression_equals_the_forest(spark):
    rows, _ = corpus()
    found = sx.findings(spark.createDataFrame(rows, SCHEMA))
    model = sx.train(found)
    vector = __import__("pyspark.ml.functions", fromlist=["array_to_vector"]).array_to_vector("features")
    both = model.transform(found.select(F.col("features").alias("x"), vector.alias("features"))).select(
        sx.probability(model, F.col("x")).alias("p"), "x", "prediction").collect()
    assert both and all((r.p > 0.5) == (r.prediction == 1.0) for r in both if abs(r.p - 0.5) > 0.2)


def test_neighbours_are_not_swallowed(spark):
    a, b = "AKIA" + "A1B2C3D4E5F6G7H8", "AKIA" + "Z1B2C3D4E5F6G7H9"
    rows = sx.with_candidates(spark.createDataFrame([(1, f"{a} {b} and {a}", "", 1)], SCHEMA)).first()
    assert [c.value for c in rows["_c"]] == [a, b, a]


def test_empty_and_one_sided_tables(spark):
    assert sx.scan(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, "password=0123456789abcdef01 here", "", 1)], SCHEMA)
    assert sx.scan(one).first().n_secrets == 1 and sx.SECRET in sx.redact(one).first().text


def test_long_short_and_unusual_secrets_are_whole(spark):
    long = "".join(random.Random(5).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=410))
    texts = [(f"use token={long} now", long), ("set db_pass: s3cr3tPa55w0rd here", "s3cr3tPa55w0rd"),
             ('the password = "Tr0ub4dor!9$kLm#22pq" end', "Tr0ub4dor!9$kLm#22pq"), ("with password=Tr0ub4dorLongLong16!x9$ end", "Tr0ub4dorLongLong16!x9$"),
             ('{"api_key": "a1!b2#c3$"}', "a1!b2#c3$")]
    rows = sx.with_candidates(spark.createDataFrame([(i, t, "", 1) for i, (t, _) in enumerate(texts)], SCHEMA)).orderBy("doc_id").collect()
    assert [[c.value for c in r["_c"]] for r in rows] == [[v] for _, v in texts]
    assert all(c.assigned for r in rows for c in r["_c"])
    docs = corpus()[0] + [(1000 + i, t, "", 1) for i, (t, _) in enumerate(texts)]
    out = {r.doc_id: r.text for r in sx.redact(spark.createDataFrame(docs, SCHEMA)).collect()}
    for i, (t, v) in enumerate(texts):
        assert out[1000 + i] == t.replace(v, sx.SECRET)


def test_starts_of_matches(spark):
    """A candidate is found behind any character; a name of any length is the assigned name."""
    run, name = "A1b2C3d4E5f6G7h8I9j0", "a_very_long_name_of_a_setting_that_goes_on"
    texts = {f"see,{run}": ("", False), f'9abc="{run}"': ("abc", True), f"{name}={run}": (name, True), f"x({run}) y": ("", False),
             f"two words {run}": ("words", False), f"a bc  {run}": ("bc", False), f"é{run}": ("", False), f"thelongestwordofall {run}": ("", False)}
    rows = sx.with_candidates(spark.createDataFrame([(i, t, "", 1) for i, t in enumerate(texts)], SCHEMA)).orderBy("doc_id").collect()
    for r, (name, assigned) in zip(rows, texts.values(), strict=True):
        assert [(c.value[-20:], c.name, c.assigned) for c in r["_c"]] == [(run, name, assigned)], r.text
