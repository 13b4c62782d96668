"""Secret scans: native candidate patterns and a random forest.

Candidates have two forms.  A value that is quoted or assigned right after a
hint word is one whatever its length or signs (found in the whole text, so a
quoted value may hold spaces).  Elsewhere, runs of 16 or more letters, digits
and +/_- signs are, found word by word.  The words before (the hint word and
what stands between, for the first form) and the four words after are the
context.  Features, all native columns: length, transitions between character
classes, share of the token covered by dictionary words, signs, the path
(source), the words before it and after it.  A random forest trained from
labelled findings removes false positives.  When no findings are given they
come from the corpus: a bounded sample of candidates (``max_findings``, by
hash), labelled 1 when a key, token or password word stands before them (or
after them: "is the token") or a provider's fixed prefix begins them, else 0;
references to a value that stands elsewhere (``${NAME}``, ``<name>``, calls,
null) are labelled 0.

Nulls and edge cases: null or empty texts have no candidates; a text of any
length is searched whole, in time that grows with its length; a null path is
empty; findings without ``after`` have no words after them; a candidate repeated in a text is reported once per occurrence; with
findings of one class only every candidate gets that class; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: fixed values: neighbouring words and prefixes that mark secrets
WORD = r"(?:key|token|secret|passw(?:or)?d|pwd|credential|auth)"
HINTS = rf"(?i){WORD}\W{{0,6}}$"
PREFIXES = r"^(?:AKIA|ASIA|ghp_|gho_|xox[abp]-|sk_live_)"
LONG = "[A-Za-z0-9+/_-]{16,}"
#: what an AWS id looks like after its prefix; words such as ASIAN- are none
AWS = r"^(?:AKIA|ASIA)(?![A-Z0-9]{16}$)"
#: hint word, assignment and opening quote; the value; words after it
ASSIGNED = (rf"((?i:{WORD})[\"']?+(?:\s*+(?::\s*+[A-Za-z_][\w.\[\]]*+\s*+(?==))?+(?:=>|:=|==?|:))?+\s*+[\"']?)"
            r"((?<=\")[^\"\n]+(?=\")|(?<=')[^'\n]+(?=')|(?<=[=:>]\s{0,9}[\"']?)[^\s\"',;)\]}]\S*+)"
            r"(?=(\S*+(?:\s++\S++){0,4}+))")
#: signs that close a value without quotes; looked for once per run of them
CLOSERS = r"(?<![\"',;)\]}])[\"',;)\]}]++$"
REFERENCE = r"^(?:\$?\{.*\}?|<.*>?|%\w+%|(?i:null|none|nil|true|false|undefined)|[A-Za-z_][\w.]*[(\[].*)$"
FEATURES = ["length", "to_digit", "to_letter", "case_turns", "digits", "uppers", "dictionary", "vowels", "signs", "hinted", "assigned", "prefixed",
            "reference", "closed", "hint_after", "sample_after", "test_path"]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, path, before, value, after)."""
    texts = docs.where("text is not null").select("doc_id", F.coalesce("source", F.lit("")).alias("path"), "text")
    found = F.col("text").rlike(ASSIGNED)
    part = lambda k: F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(k))
    assigned = (texts.where(found).select("doc_id", "path", F.explode(F.arrays_zip(part(1).alias("b"), part(2).alias("v"), part(3).alias("a"))).alias("z"))
                .withColumn("shut", F.when(F.col("z.a").rlike("^[\"']"), "").otherwise(F.regexp_extract("z.v", CLOSERS, 0)))
                .select("doc_id", "path", F.expr("substring(z.v, 1, length(z.v) - length(shut))").alias("value"), F.regexp_replace(F.regexp_replace("z.b", r":\s*[A-Za-z_][\w.\[\]]*\s*=", " ="), r"\s+", " ").alias("before"),
                        F.concat("shut", "z.a").alias("after")))
    # the others are looked for where no assigned value stands
    rest = F.when(found, F.regexp_replace("text", ASSIGNED, "$1\u0001")).otherwise(F.col("text"))
    words = texts.where(F.col("text").rlike(LONG)).select("doc_id", "path", F.split(rest, r"\s+").alias("words"))
    long = (words.select("doc_id", "path", "words", F.posexplode("words").alias("i", "w")).where(F.col("w").rlike(LONG))
            .select("doc_id", "path", "w", F.concat_ws(" ", F.get("words", F.col("i") - 2), F.get("words", F.col("i") - 1)).alias("b"),
                    F.array_join(F.slice("words", F.col("i") + 2, 4), " ").alias("a"),
                    F.explode(F.expr(f"regexp_extract_all(w, '{LONG}', 0)")).alias("value"))
            .withColumn("head", F.expr("substring_index(w, value, 1)"))
            .select("doc_id", "path", "value", F.concat_ws(" ", "b", "head").alias("before"),
                    F.concat_ws(" ", F.expr("substring(w, length(head) + length(value) + 1)"), "a").alias("after")))
    return assigned.unionByName(long)


def featured(found: DataFrame) -> DataFrame:
    n = lambda p: F.regexp_count("value", F.lit(p)).cast("double")
    yes = lambda c: c.cast("double")
    size = F.length("value").cast("double")
    if "after" not in found.columns:
        found = found.withColumn("after", F.lit(""))
    return found.select(
        "*", size.alias("length"), (n("(?<=[A-Za-z])[0-9]") / size).alias("to_digit"), (n("(?<=[0-9])[A-Za-z]") / size).alias("to_letter"),
        (n("(?<=[a-z])[A-Z]") / size).alias("case_turns"), (n("[0-9]") / size).alias("digits"), (n("[A-Z]") / size).alias("uppers"),
        (F.length(F.regexp_replace("value", "[^a-z]|[a-z]{1,3}(?![a-z])", "")) / size).cast("double").alias("dictionary"),
        (n("[aeiouAEIOU]") / size).alias("vowels"), (n("[^A-Za-z0-9]") / size).alias("signs"), yes(F.col("before").rlike(HINTS)).alias("hinted"),
        yes(F.col("before").rlike(r"[=:]\s*[\"']?$")).alias("assigned"), yes(F.col("value").rlike(PREFIXES)).alias("prefixed"),
        yes(F.col("value").rlike(REFERENCE)).alias("reference"), yes(F.col("after").rlike("^[\"']")).alias("closed"),
        yes(F.col("after").rlike(rf"(?i){WORD}")).alias("hint_after"), yes(F.col("after").rlike(r"(?i)example|sample|dummy|fake|placeholder")).alias("sample_after"),
        yes(F.lower("path").rlike("test|example|sample|doc")).alias("test_path"))


def scan(docs: DataFrame, findings: DataFrame | None = None, trees: int = 20, max_findings: int = 20_000) -> DataFrame:
    """doc_id, secret, probability, is_secret for every candidate.

    ``findings``: path, before, value, label and, optionally, after.
    """
    rows = featured(common.cut(candidates(docs)))  # read several times; the texts once
    if findings is None:
        known = (F.col("before").rlike(HINTS[:-1] + r"\s*[\"']?$") | F.col("after").rlike(rf"(?i)\b(?:is|as)\s(?:\w+\s){{0,2}}{WORD}")
                 | (F.col("value").rlike(PREFIXES) & ~F.col("value").rlike(AWS))) & ~F.col("value").rlike(REFERENCE)
        labelled = rows.withColumn("label", known.cast("double"))
        labelled = labelled.withColumn("_r", F.xxhash64("value", "before", "doc_id")).orderBy("label", "_r")
        half = max_findings // 2
        train = labelled.where("label = 1").limit(half).unionByName(labelled.where("label = 0").limit(half))
    else:
        train = featured(findings)
    pack = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = pack.transform(train).select("features", F.col("label").cast("double").alias("label"))
    classes = [r[0] for r in train.select("label").distinct().collect()]
    if len(classes) < 2:
        p = F.lit(float(classes[0]) if classes else 0.0)
        out = rows.withColumn("probability", p)
    else:
        model = RandomForestClassifier(numTrees=trees, maxDepth=6, seed=7).fit(train)
        out = model.transform(pack.transform(rows).select("doc_id", "value", "features")).withColumn("probability", vector_to_array("probability")[1])
    return out.select("doc_id", F.col("value").alias("secret"), "probability", (F.col("probability") >= 0.5).alias("is_secret"))
