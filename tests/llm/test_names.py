"""Extra columns with the names that operators use themselves stay as they are."""

import corpus_pipeline
from lumbung.llm import language, pseudonyms, secrets

NAMES = ["score", "lang_pred", "ambiguous", "_text", "_letter", "_id", "_th", "_c", "_found", "_v", "_kinds", "kinds", "found", "row", "n_email", "_bad_id", "_bad_th", "part", "a b"]
TEXTS = ["the cat and the dog went home to eat", "der hund und die katze gehen nach haus", "write to ann@example.org now", None, "", "api_key = 9f8e7d6c5b4a39281706f5e4d3c2b1a0"]


def table(spark):
    rows = [(i, t, "en" if i % 2 else "de", "s", len(t or "")) + tuple(f"{n}{i}" for n in NAMES) for i, t in enumerate(TEXTS * 3)]
    fields = ["doc_id long", "text string", "lang string", "source string", "n_chars long", *(f"`{n}` string" for n in NAMES)]
    return spark.createDataFrame(rows, ", ".join(fields)), {r[0]: r[5:] for r in rows}


def check(out, df, extras):
    assert out.columns[: len(df.columns)] == df.columns
    got = out.collect()
    assert all(tuple(r)[5 : len(df.columns)] == extras[r[0]] for r in got)
    return got


def test_stages(spark, tmp_path):
    df, extras = table(spark)
    spark.createDataFrame([(1, "nothing of the kind stands in any of these texts at all.")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns and check(out, df, extras)
    assert corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).count() == len(extras)


def test_redact_and_pseudonymise(spark):
    df, extras = table(spark)
    assert len(check(secrets.redact(df), df, extras)) == len(extras)
    df, at = df.drop("n_email"), NAMES.index("n_email")
    extras = {d: x[:at] + x[at + 1 :] for d, x in extras.items()}
    out = pseudonyms.pseudonymise(df.withColumn("N_Email", df["doc_id"]), "k")  # a count replaces a column of its name
    got = check(out, df, extras)
    assert len(got) == len(extras) and out.columns[-5:] == ["n_email", "n_ip", "n_date", "n_phone", "n_card"]
    assert sum(r["n_email"] for r in got) == 3


def test_predict(spark):
    df, extras = table(spark)
    got = language.predict(df, language.train(df), "doc_id", "_text", "score").collect()
    assert {r.doc_id: r["_text"] for r in got} == {d: x[NAMES.index("_text")] for d, x in extras.items()}
    assert all(isinstance(r.score, float) for r in got)


def test_key(spark):
    """Without a key every call draws its own; the session setting gives one."""
    df = spark.createDataFrame([(1, "card 4111111111111111 of ann.miller@example.org")], "doc_id long, text string")
    assert pseudonyms.pseudonymise(df).first().text != pseudonyms.pseudonymise(df).first().text
    spark.conf.set(pseudonyms.KEY_SETTING, "one")
    try:
        assert pseudonyms.pseudonymise(df).first().text == pseudonyms.pseudonymise(df, "one").first().text
    finally:
        spark.conf.unset(pseudonyms.KEY_SETTING)
