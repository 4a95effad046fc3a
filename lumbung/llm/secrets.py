"""Secret scans: a random forest removes false positives among candidate strings, DataFrame functions only.

Candidates are whole runs of ``SHORTEST`` or more characters of keys, tokens and paths, with a
digit, an assignment or a provider format, and whatever non-blank value of ``ASSIGNED`` or more characters is
assigned to a credential's name; at most two shorter words before each are its neighbours. Features: length;
shares of digits, capitals, small letters; share of neighbouring characters that change class or
case; share of distinct characters; share covered by dictionary words; path separators; whether it
is assigned, quoted, all hexadecimal, named like a credential, or passes as a plain number.

The forest (Spark ML) is trained on labelled findings: rows of the features and a label. For the
tables, which have no such labels, ``labelled`` derives findings from formats that leave no doubt
and leaves the others out; the forest decides on those. Training takes ``SAMPLE`` findings of each
label at most, those with the smallest hashes. The trees are then written out as one expression on
the array of a text's candidates, so scoring needs no shuffle and no function outside Spark SQL.

Edge cases: null text has no findings and stays null; without findings of both labels the labels
themselves decide (no label: not a secret); repeated rows are scanned alike; an empty table gives
an empty result; ``redact`` keeps all columns, whatever their names. A very long text is one row with an array of
its candidates. At one place of the text the longest context is taken; equal values are one secret to ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.common import beside, put_back
from lumbung.sources.staging import stage

SHORTEST, ASSIGNED = 16, 6
SAMPLE, PARTS = 3000, 64
TREES, DEPTH = 20, 5
SECRET = "<SECRET>"

# Names that credentials are assigned to, provider formats and frequent words (fixed values).
NAMES = "password passwd pass pwd token secret api_key apikey access_key auth key credential private_key client_secret bearer"
FORMATS = r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^AIza[0-9A-Za-z_-]{35}$|^sk_live_[0-9A-Za-z]{16,}$"
WORDS = (
    "the and that with for was are this from have not you all were her his they will would there their what about which when one can said "
    "der die und den von das mit sich des auf für ist nicht ein eine als auch werden aus hat dass wird bei "
    "les des est une dans que pour qui sur pas plus par avec tout mais nous vous leur los las una por con para del como pero sus este example test user data file http https www com org index html"
)
_NAMES = "|".join(NAMES.split())
_WORDS = "|".join(w for w in WORDS.split() if len(w) >= 3)
_PLAIN = rf"[A-Za-z0-9_\-/+=.~:]{{{SHORTEST},}}+"
_GIVEN = rf"[\"'(<\[{{]{{0,2}}(?=[\w.\-]{{1,60}}+[\"']?+\s{{0,4}}+[=:])([\w.\-]{{0,60}}?(?<![A-Za-z])(?i:{_NAMES}))[\"']?\s{{0,4}}[=:]{{1,2}}\s{{0,4}}"
_VALUE = rf"(\"[^\"\s]{{{ASSIGNED},}}+\"?|'[^'\s]{{{ASSIGNED},}}+'?|[^\s\"']\S{{{ASSIGNED - 1},}}+)"
# A match starts where a name or a run can: not behind a letter, or at a quote or bracket. Before the context of a run is
# taken, one look over at most two short words must meet 16 characters without a blank.
_START = r"(?:(?<![A-Za-z_])|(?=[\"'(<\[{]))"
_AHEAD = rf"(?=(?:\S{{1,{SHORTEST - 1}}}+\s{{1,4}}+){{0,2}}+\S{{{SHORTEST}}})"
_RUN = rf"(?:[\"'(<\[{{]{{0,2}}[A-Za-z_]++[=:][\"']?)?[\"'(<\[{{]{{0,2}}{_PLAIN}"
CONTEXT = rf"{_START}(?:(?<![\w.\-]){_GIVEN}{_VALUE}|{_AHEAD}(?:(?<!\S)(?!(?<![\w.\-]){_GIVEN}{_VALUE})\S{{1,{SHORTEST - 1}}}+\s{{1,4}}+){{0,2}}(?!(?<![\w.\-]){_GIVEN}{_VALUE}){_RUN})"
_KEY_VALUE = r"^[\"'(<\[{]{0,2}([A-Za-z_]+)[=:][\"']?(.+)$"
FEATURES = ["length", "digits", "capitals", "small", "changes", "distinct", "dictionary", "path", "assigned", "quoted", "hexadecimal", "named", "number"]


def _parts(context: Column) -> Column:
    """struct(value, name, quoted, assigned) of a match of ``CONTEXT``."""
    token = F.regexp_extract(context, r"(\S+)$", 1)
    inner = F.regexp_extract(token, _KEY_VALUE, 2)
    # a name joined by = or : in the same token, or the word before a free-standing = or :
    joined = (F.regexp_extract(token, _KEY_VALUE, 1) != "") & (F.length(inner) >= SHORTEST)
    before = F.regexp_extract(context, r"(\S+)\s+[=:]{1,2}\s+\S+$", 1)
    near = F.regexp_extract(context, r"(\S+)\s+\S+$", 1)
    given = F.regexp_extract(context, rf"^{_GIVEN}{_VALUE}$", 2)
    name = F.when(given != "", F.regexp_extract(context, rf"^{_GIVEN}{_VALUE}$", 1)).when(joined, F.regexp_extract(token, _KEY_VALUE, 1)).when(before != "", before).otherwise(near)
    raw = F.when(given != "", given).when(joined, inner).otherwise(token)
    value = F.regexp_replace(raw, r"^[\"'(<\[{]+|[\"')>\]}.,;:]+$", "")
    return F.struct(value.alias("value"), F.lower(name).alias("name"), raw.rlike(r"^[\"']").alias("quoted"), (joined | (before != "") | (given != "")).alias("assigned"))


def _named(c: Column) -> Column:
    return c["name"].rlike(rf"(?:^|[^a-z])(?:{_NAMES})$")


def with_candidates(docs: DataFrame, text: str = "text", to: str = "_c") -> DataFrame:
    """Column ``to``: the text's candidates in order, each struct(value, name, quoted, assigned)."""
    found = F.transform(F.regexp_extract_all(text, F.lit(CONTEXT), F.lit(0)), _parts)
    return docs.withColumn(to, F.coalesce(F.filter(found, lambda c: ((F.length(c["value"]) >= SHORTEST) | (c["assigned"] & _named(c) & (F.length(c["value"]) >= ASSIGNED))) & (c["value"].rlike("[0-9]") | c["assigned"] | c["value"].rlike(FORMATS))), F.array()))


def features(c: Column) -> Column:
    """Array of doubles in the order of ``FEATURES``."""
    value = c["value"]
    n = F.greatest(F.length(value), F.lit(1)).cast("double")

    def kept(pattern: str) -> Column:
        return F.length(F.regexp_replace(value, pattern, "")) / n

    changes = F.size(F.regexp_extract_all(value, F.lit(r"[0-9](?=[^0-9])|[A-Z](?=[^A-Z])|[a-z](?=[^a-z])"), F.lit(0)))
    return F.array(
        n, kept("[^0-9]"), kept("[^A-Z]"), kept("[^a-z]"), changes / n, F.size(F.array_distinct(F.split(value, ""))) / n,
        1 - F.length(F.regexp_replace(F.lower(value), _WORDS, "")) / n, F.length(F.regexp_replace(value, r"[^/.\\:]", "")).cast("double"),
        c["assigned"].cast("double"), c["quoted"].cast("double"), value.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double"),
        _named(c).cast("double"), value.rlike(r"^[0-9.:\-/+]+$").cast("double"))


def labelled(c: Column) -> Column:
    """1 for known formats and assigned credentials, 0 for numbers, addresses and words, null where neither is plain."""
    value = c["value"]
    mixed = (F.size(F.regexp_extract_all(value, F.lit("[0-9]"), F.lit(0))) >= 3) & value.rlike("[A-Za-z]") & ~value.rlike(r"[./\\]")
    return F.when(value.rlike(FORMATS), 1).when(c["assigned"] & _named(c) & mixed, 1).when(
        value.rlike(r"^[0-9.:\-/+]+$") | value.rlike(r"^[A-Za-z.:/\-]+[0-9]{0,4}$") | value.rlike(r"^https?:"), 0)


def findings(docs: DataFrame) -> DataFrame:
    """label, value, features of the candidates of all documents that ``labelled`` tells apart."""
    return _told_apart(with_candidates(docs.select("text")))


def _told_apart(rows: DataFrame) -> DataFrame:
    rows = rows.filter(F.size("_c") > 0).select(F.explode("_c").alias("c"))
    rows = rows.select(labelled(F.col("c")).alias("label"), F.col("c.value").alias("value"), features(F.col("c")).alias("features"))
    return rows.filter("label IS NOT NULL")


def train(found: DataFrame, sample: int = SAMPLE):
    """The fitted forest of (label, value, features), or None where a label is missing."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    # First the smallest of each of ``parts`` hash ranges, so that no task orders all findings of a label.
    by = [F.xxhash64("value"), F.col("value"), F.xxhash64("features")]
    part = F.pmod(F.xxhash64("value", "features"), F.lit(PARTS))
    few = found.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("label", "part").orderBy(*by))).filter(F.col("place") <= sample)
    rows = few.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy(*by))).filter(F.col("place") <= sample).select(F.col("label").cast("double").alias("label"), "features")
    rows = stage(rows, "findings")  # training reads it several times
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=3).fit(rows.select("label", array_to_vector("features").alias("features")))


def _tree(node, x: Column) -> Column:
    if node.numDescendants() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(x[split.featureIndex()] <= F.lit(float(split.threshold())), _tree(node.leftChild(), x)).otherwise(_tree(node.rightChild(), x))


def probability(model, x: Column) -> Column:
    """Share of the forest's trees that vote for a secret, as one expression on the array of features."""
    votes = [_tree(tree._call_java("rootNode"), x) for tree in model.trees]
    total = votes[0]
    for vote in votes[1:]:
        total = total + vote
    return total / len(votes)


def with_secrets(docs: DataFrame, model, text: str = "text", to: str = "_found") -> DataFrame:
    """Column ``to``: candidates with their probability, struct(value, name, p)."""
    return _scored(with_candidates(docs, text, "_c"), model, to)


def _scored(rows: DataFrame, model, to: str = "_found") -> DataFrame:
    if model is None:
        scored = F.transform("_c", lambda c: F.coalesce(labelled(c), F.lit(0)).cast("double"))
    else:
        scored = F.transform(F.transform("_c", features), lambda x: probability(model, x))
    return rows.withColumn(to, F.zip_with("_c", scored, lambda c, p: F.struct(c["value"].alias("value"), c["name"].alias("name"), p.alias("p")))).drop("_c")


def _secret(found: str) -> Column:
    return F.filter(found, lambda x: x["p"] >= 0.5)


def scan(docs: DataFrame, model=None) -> DataFrame:
    """doc_id, n_candidates, n_secrets, n_rejected, secrets (value, name, p); the model is trained on ``docs`` if none is given.

    Candidates are staged without the texts, so training and scoring read the corpus once.
    """
    found = with_candidates(docs.select("doc_id", "text")).select("doc_id", "_c")
    if model is None:
        found = stage(found, "candidates")
        model = train(_told_apart(found))
    rows = _scored(found, model)
    secrets = _secret("_found")
    return rows.select(
        "doc_id", F.size("_found").cast("long").alias("n_candidates"), F.size(secrets).cast("long").alias("n_secrets"),
        (F.size("_found") - F.size(secrets)).cast("long").alias("n_rejected"), secrets.alias("secrets"))


def redact(docs: DataFrame, model=None) -> DataFrame:
    """All columns, with every secret in ``text`` replaced by ``SECRET``; longer secrets first, so none is cut."""
    model = model or train(findings(docs))
    rows = with_secrets(docs.select(beside(docs, "text"), "text"), model, "text", "_found")
    values = F.array_sort(F.array_distinct(F.transform(_secret("_found"), lambda x: x["value"])), lambda a, b: F.length(b) - F.length(a))
    text = F.aggregate("_v", F.col("text"), lambda t, v: F.replace(t, v, F.lit(SECRET)))
    done = rows.withColumn("_v", values).withColumn("text", F.when(F.size("_v") > 0, text).otherwise(F.col("text")))
    return done.select(*put_back(docs, "text"))
