"""Operator 2: secret scan with a random forest that removes false positives. Native: no Python on executors.

- *Candidates.* In whole texts: every run of at least twelve characters of the usual
  secret alphabets that holds a digit; everything in an issuer's format; and the whole value
  (six characters and more, of any kind but blanks) assigned to a credential's name.
- *Features.* Length; character transitions (changes between lower case, upper case,
  digits and marks) and the share of each class; distinct characters; dictionary coverage
  (the part of the candidate made of the corpus's own frequent words); words of the path
  and neighbouring words, hashed.
- *Forest.* Trained on labelled findings, so it tells secrets from card numbers, addresses,
  hosts and the like. `weak_labels` labels those findings of a corpus that an issuer's
  format, an assignment to a credential's name or a plain number settles; findings that
  people have labelled can be given instead. Training takes at most `most_labelled`
  findings of each label, smallest hash first; the dictionary is counted over all texts.

Defined results: null and empty texts have no findings; a candidate that a text repeats
is one finding with its number of occurrences; without labelled findings of both kinds
nothing can be told apart, and every candidate keeps the share of positive labels as its
score (0.5 without any labels). `documents` without rows has no findings. Columns of any other
name are handed on as they are.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapflow.llm.common import hash_bitmap, may_hold, own_columns, stored, text_or_empty, unused_name

SHORTEST = 12
RUN = r"[A-Za-z0-9_+/.@-]{12,}+={0,2}"
NEIGHBOURS = 3
HASHED = 64
TREES = 30
DEPTH = 6
MOST_LABELLED = 10_000
DICTIONARY = 1_000
THRESHOLD = 0.5
#: Formats that issuers publish, and names of credentials.
ISSUED = r"^(?:AKIA[A-Z0-9]{16}|ASIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abpr]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$"
CREDENTIAL = r"(?i)^(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|auth|credentials?|bearer)$"
E_MAIL = r"^[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"
HARMLESS = r"^[0-9.+/_-]+$|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}"
ISSUED_INSIDE = f"(?<![A-Za-z0-9]){ISSUED[1:-1]}(?![A-Za-z0-9])"
NAME = "(?i:" + CREDENTIAL.removeprefix("(?i)^").removesuffix("$").replace("api_?key", "api[_-]?key").replace("access_?key", "access[_-]?key") + ")[\"'`]?"
SIGN = "[:=]+>?"
#: A name begins after anything but a letter, or at a change of case (clientSecret).
NAME_START = "(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))"
ASSIGNED = f"{NAME_START}{NAME} ?{SIGN} ?"
QUOTED_VALUE = ASSIGNED + r"[\"'`]([^\s\"'`]{6,})[\"'`]\S*$"
PLAIN_VALUE = ASSIGNED + r"([^\s\"'`=:]\S{4,}[^\s\"'`,;.)\]}])[\"'`,;.)\]}]*$"
SHAPE = ["length", "lower", "upper", "digit", "mark", "changes", "hex", "distinct", "covered"]


def _named(near: Column) -> Column:
    """Whether a credential's name stands among the words before."""
    return F.exists(near, lambda w: F.regexp_replace(w, "^before ", "").rlike(CREDENTIAL))


def candidates(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per text and distinct candidate: doc_id, text_key, candidate, occurrences, near (neighbouring words, the path's too)."""
    place = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")

    def hits(words: Column) -> Column:
        """Long words with a digit, issued ones and assigned ones, and their neighbours. `words` is a variable, so a text is split once."""
        back = lambda i, k, pattern: F.coalesce(F.when(i >= k, F.get(words, i - k)).rlike(pattern), F.lit(False))
        assigned = lambda i: (
            F.get(words, i).rlike(f"{NAME}{SIGN}")
            | back(i, 1, f"{NAME}{SIGN}$")
            | (back(i, 1, f"^{SIGN}$") & back(i, 2, f"{NAME}$"))
            | (F.get(words, i).rlike(f"^{SIGN}") & back(i, 1, f"{NAME}$"))
        )
        at = F.filter(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: ((F.length(F.get(words, i)) >= SHORTEST) & F.get(words, i).rlike("[0-9]")) | F.get(words, i).rlike(ISSUED_INSIDE) | assigned(i),
        )
        before = lambda i: F.slice(words, F.greatest(i - NEIGHBOURS + 1, F.lit(1)), F.least(i, F.lit(NEIGHBOURS)))
        after = lambda i: F.slice(words, i + 2, F.lit(NEIGHBOURS))
        return F.transform(at, lambda i: F.struct(F.get(words, i).alias("word"), before(i).alias("before"), after(i).alias("after")))

    split = F.array(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"))
    met = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("text_key"),
        place.alias("place"),
        F.explode(F.flatten(F.transform(split, hits))).alias("hit"),
    )
    met = met.select("doc_id", "text_key", "place", "hit.word", "hit.before", "hit.after")
    # The name may stand up to two words before the value.
    context = F.concat_ws(" ", F.array_join(F.slice("before", F.greatest(F.size("before") - 1, F.lit(1)), F.lit(2)), " "), "word")
    quoted, plain = (F.regexp_extract(context, pattern, 1) for pattern in (QUOTED_VALUE, PLAIN_VALUE))
    value = F.when(quoted != "", quoted).otherwise(plain)
    met = met.withColumn("value", F.when(F.contains("word", value), value).otherwise(""))
    long = F.filter(F.regexp_extract_all("word", F.lit(RUN), F.lit(0)), lambda c: c.rlike("[0-9]"))
    issued = F.regexp_extract_all("word", F.lit(ISSUED_INSIDE), F.lit(0))
    more = F.filter(F.concat(issued, F.array("value")), lambda c: c != "")
    runs = met.select("*", F.explode(F.concat(long, F.array_except(more, long))).alias("candidate"))
    own = F.replace("word", F.col("candidate"), F.lit(" "))

    def named(part: str, text: Column) -> Column:
        found = F.filter(F.split(F.lower(text), "[^a-z_]+"), lambda w: F.length(w) > 1)
        return F.transform(found, lambda w: F.concat(F.lit(part), w))

    near = F.concat(
        named("before ", F.concat_ws(" ", F.array_join("before", " "), own)),
        named("after ", F.array_join("after", " ")),
        named("path ", F.col("place")),
    )
    # A name such as db_password is no credential's name by itself.
    near = F.when((F.col("candidate") == F.col("value")) & ~_named(near), F.array_append(near, F.lit("before credential"))).otherwise(near)
    return (
        runs.select("doc_id", "text_key", "candidate", near.alias("near"))
        .groupBy("doc_id", "text_key", "candidate")
        .agg(F.count(F.lit(1)).alias("occurrences"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("near")))).alias("near"))
    )


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent plain words of four to ten letters, counted over all texts."""
    word = F.explode(F.regexp_extract_all(F.lower(text_or_empty()), F.lit("(?<![a-z0-9])[a-z]{4,10}(?![a-z0-9])"), F.lit(0))).alias("word")
    counted = docs.select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(size).collect()]


def shaped(found: DataFrame, known: list[str]) -> DataFrame:
    """Candidates with the numeric features."""
    c = F.col("candidate")
    size = F.length(c).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / size

    changes = "[a-z](?![a-z])|[A-Z](?![A-Z])|[0-9](?![0-9])|[^A-Za-z0-9](?=[A-Za-z0-9])"
    # Letters only; longest words first, as alternatives are tried in order.
    pattern = "|".join(sorted(known, key=lambda w: (-len(w), w))) or "(?!)"
    uncovered = F.length(F.regexp_replace(F.lower(c), pattern, ""))
    return found.select(
        "*",
        size.alias("length"),
        share("[a-z]").alias("lower"),
        share("[A-Z]").alias("upper"),
        share("[0-9]").alias("digit"),
        share("[^A-Za-z0-9]").alias("mark"),
        share(changes).alias("changes"),
        share("[0-9a-f]").alias("hex"),
        (F.size(F.array_distinct(F.split(c, ""))) / size).alias("distinct"),
        ((size - uncovered) / size).alias("covered"),
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings that a format settles, with `label` 1 (secret) or 0."""
    named = _named(F.col("near"))
    harmless = F.col("candidate").rlike(HARMLESS) | (F.col("candidate").rlike(E_MAIL) & ~named)
    label = F.when(F.col("candidate").rlike(ISSUED), 1).when(harmless, 0).when(named, 1)
    return found.withColumn("label", label).where("label is not null")


class SecretModel:
    """Forest over the features; without both labels a constant score."""

    def __init__(self, stages: PipelineModel | None, share: float):
        self.stages, self.share = stages, share

    def scored(self, features: DataFrame) -> DataFrame:
        if self.stages is None:
            return features.withColumn("score", F.lit(self.share))
        return self.stages.transform(features).withColumn("score", vector_to_array("probability")[1])


def train(labelled: DataFrame, most_labelled: int = MOST_LABELLED) -> SecretModel:
    """Forest from labelled findings (columns of `shaped`, and `label`)."""
    order = [F.xxhash64("candidate", "doc_id"), "candidate", "doc_id"]
    sample = labelled.where("label = 1").orderBy(*order).limit(most_labelled).unionByName(
        labelled.where("label = 0").orderBy(*order).limit(most_labelled)
    )
    # A bounded sample, in one order: the same forest each time.
    sample = stored(sample.select("candidate", "doc_id", "near", *SHAPE, F.col("label").cast("double")).coalesce(1).sortWithinPartitions(*order), "labelled-findings")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return SecretModel(None, 0.5 if not counts else next(iter(counts)))
    hashed = HashingTF(inputCol="near", outputCol="near_hashed", numFeatures=HASHED, binary=True)
    vector = VectorAssembler(inputCols=[*SHAPE, "near_hashed"], outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=17, maxBins=64, minInstancesPerNode=2)
    fitted = forest.fit(vector.transform(hashed.transform(sample)))
    return SecretModel(PipelineModel([hashed, vector, fitted]), 0.5)


def scan(docs: DataFrame, path: str | None = None, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Findings: doc_id, text_key, candidate, occurrences, score, secret."""
    found = stored(shaped(candidates(docs, path), dictionary(docs)), "candidates")
    model = train(weak_labels(found) if labelled is None else labelled)
    return model.scored(found).select(
        "doc_id", "text_key", "candidate", "occurrences", "score", (F.col("score") >= threshold).alias("secret")
    )


def _quoted(value: Column) -> Column:
    """A pattern for the value itself, between the borders of a word where it begins or ends like one."""
    plain = F.concat(F.lit(r"\Q"), F.replace(value, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    before = F.when(value.rlike("^[A-Za-z0-9]"), F.lit("(?<![A-Za-z0-9])")).otherwise("")
    after = F.when(value.rlike("[A-Za-z0-9]$"), F.lit("(?![A-Za-z0-9])")).otherwise("")
    return F.concat(before, plain, after)


def without_secret(text: Column, secret: Column, mark: str) -> Column:
    """The text with a secret replaced wherever it was found.

    Values with a digit and twelve characters or more, and those in an issuer's format, are too random for a
    word and go wherever they stand by themselves; any other only where it is assigned to a credential's name.
    """
    put = mark.replace("\\", "\\\\").replace("$", "\\$")
    random = secret.rlike(ISSUED) | (secret.rlike(f"^{RUN}$") & secret.rlike("[0-9]"))
    assigned = F.concat(F.lit(f"({NAME_START}{NAME}\\s*{SIGN}\\s*[\"'`]?)"), _quoted(secret))
    there = F.regexp_replace(text, assigned, F.lit("$1" + put))
    return F.when(random, F.regexp_replace(text, _quoted(secret), F.lit(put))).otherwise(there)


def redact(docs: DataFrame, path: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, secrets in `text` replaced by a mark; a `n_chars` column follows the text."""
    found = scan(docs, path).where("secret")
    longest = lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)
    key_name, list_name = unused_name(docs, "secret_key"), unused_name(docs, "secrets")
    secrets = (
        found.select(F.col("text_key").alias(key_name), "candidate")
        .groupBy(key_name)
        .agg(F.array_sort(F.collect_set("candidate"), longest).alias(list_name))
    )
    secrets = stored(secrets, "secrets")
    # Texts whose hash falls in no slot of a fixed bitmap hold no secret, and need no join.
    key = F.xxhash64(text_or_empty())
    possible = may_hold(hash_bitmap(secrets.select(F.col(key_name).alias("hash"))), key)
    joined = docs.where(possible).join(secrets, key == F.col(key_name), "left")
    clean = F.when(F.col(list_name).isNull(), F.col("text")).otherwise(
        F.aggregate(list_name, F.col("text"), lambda text, secret: without_secret(text, secret, mark))
    )
    changed = {"text": clean}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col(list_name).isNull(), F.col("n_chars")).otherwise(F.length(clean).cast(kind))
    return docs.where(~possible).unionByName(joined.withColumns(changed).select(*own_columns(docs)))


def findings(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of documents and distinct candidate, without the secret itself."""
    return scan(docs, path).select(
        "doc_id", F.sha2("candidate", 256).alias("candidate_sha256"), F.length("candidate").alias("length"), "occurrences", "score", "secret"
    )
