"""Secret scan with a random forest against false positives, in DataFrame and
SQL operations and Spark ML only.

A pattern finds candidates in every text: whatever is assigned to a name with a
credential word in it (quoted, or up to white space) or follows "Bearer", and
runs of key-like characters that hold a digit, follow an assignment mark or have
a known key format.  Each is
described by its length, changes of character class, share of digits, capitals,
hexadecimal and distinct characters, share covered by dictionary words (the
words common in the corpus itself), marks of a path or address, and its
neighbours: how often findings after that word, or before that one, were
secrets among the labelled ones, and whether it is assigned or quoted.  A
random forest trained on labelled findings then says which are secrets.

Without a table of labelled findings two sources serve, and neither takes its
label from a feature of the finding: findings of the corpus whose format alone
settles them (known key formats against plain numbers, addresses and host names
that no credential word assigns), and *planted* findings (:func:`planted`), values made
as secrets are made and words, numbers, calls and addresses as prose has them,
both put after the same credential words, so that there the neighbours tell
nothing and the value has to.

The pattern runs once over a text: it marks the hits, the text is split at the
marks, and everything else is taken from the parts by running sums and the parts
before and after, in time linear in the text and its hits.

Rows: null and empty texts have no findings and come back as they are; repeated
rows have theirs each; a null id is an id like any other.  Text of any length is
handled whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsieve.llm.common import id_crc_mod
from tabsieve.session import ensure_checkpoint_dir

# Candidate pattern, credential words, formats that tell what a candidate is.
RUN = "[A-Za-z0-9_+/.@-]"
CANDIDATE = rf"(?:(?<!{RUN})(?=[A-Za-z_+/.@-]*+[0-9])|(?<=[=:])){RUN}{{10,}}+|AKIA[A-Z0-9]{{16}}"
CREDENTIAL_WORDS = ["access_key", "api_key", "apikey", "auth", "bearer", "credential", "key", "passwd", "password",
                    "private_key", "pwd", "secret", "token"]
#: Before a value: a name with a credential word and an assignment mark, or "Bearer".
MARK = r"""["']?[ \t]{0,4}(?:=>|:=|[:=])"""
KEYED = (rf"(?i:(?<!{RUN})(?:{RUN}++{MARK}(?<=(?:{'|'.join(CREDENTIAL_WORDS)})[A-Za-z0-9_.-]{{0,20}}{MARK})[ \t]*+"
         r"(?:(?:bearer|basic|token)[ \t]++)?|bearer[ \t]++))")
#: A value, without its quotes or the marks of the sentence after it.
VALUE = r"""(?:"[^"\n]++(?=")|'[^'\n]++(?=')|[^\s"']*[^\s"',;.)\]}>])"""
FIND = f"{KEYED}{VALUE}|{CANDIDATE}"
KEY_FORMATS = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^xox[abpr]-[A-Za-z0-9-]{20,}$|^sk_live_[A-Za-z0-9]{20,}$"
HARMLESS_FORMATS = r"^[0-9./_+-]+$|@[A-Za-z0-9-]+\.[A-Za-z.]+$|^[A-Za-z]+[.]?$|^(www\.)?[A-Za-z0-9-]+(\.[A-Za-z]{2,})+(/.*)?$"

#: Text before a value that is assigned.
ASSIGNED = r"""(?i)(?:=>|[=:])\s*["']?$|[=:][ \t]*(?:basic|token)[ \t]+$|(?<![a-z])bearer[ \t]+$"""

REDACTED = "[SECRET]"
#: A secret of at least so many characters is replaced wherever its text has it,
#: a shorter one where it was found.
EVERYWHERE_CHARS = 10
#: Characters around a candidate in which neighbours are sought.
CONTEXT_CHARS = 48
#: A word is in the dictionary if it makes up this share of the corpus' words,
#: so the dictionary has at most 1 / share words.
DICTIONARY_SHARE = 2e-5
WORD = r"\p{L}{3,}"
#: Labelled findings of each class that the forest is trained on, at most, and
#: those of them that are planted.
SAMPLE_PER_CLASS = 8_000
PLANTED_PER_CLASS = 4_000
#: Labelled findings that a neighbouring word needs to count.
MIN_NEIGHBOURS = 5
TREES, DEPTH, SEED = 24, 9, 7

FEATURES = ["f_length", "f_changes", "f_digits", "f_capitals", "f_hex", "f_distinct", "f_dictionary", "f_path",
            "f_in_path", "f_before", "f_after", "f_assigned", "f_quoted"]


#: Set around hits; a text's own marks are read as REPLACEMENT.
HIT_MARK, REPLACEMENT = "\ue000", "\ufffd"
#: A hit has five characters or more, so so many parts of a text (hits and the
#: text between) hold the characters around a candidate.
CONTEXT_PARTS = 2 * (CONTEXT_CHARS // 5 + 1) + 1


def marked_parts(text: Column) -> Column:
    """The text split before and after every hit of the pattern: text and hits
    by turns.  One element if there is no hit; null for null."""
    return F.split(F.regexp_replace(F.translate(text, HIT_MARK, REPLACEMENT), FIND, f"{HIT_MARK}$0{HIT_MARK}"), HIT_MARK, -1)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, candidate, before, after) of every candidate in
    every whole text; ``start`` counts characters from 0.  A null or empty text
    has none; repeated rows have theirs each."""
    ensure_checkpoint_dir(docs.sparkSession)
    parts = (docs.select("doc_id", F.xxhash64("text").alias("text_key"), marked_parts(F.col("text")).alias("parts"))
             .filter(F.size("parts") > 1).withColumn("row_id", F.monotonically_increasing_id()).checkpoint())
    return _candidates(parts).drop("row_id", "no", "name")


def _candidates(parts: DataFrame) -> DataFrame:
    """Candidates of marked texts (row_id, doc_id, text_key, parts); ``no`` is
    the place of the hit among the parts, ``name`` its beginning that stays."""
    cut = parts.select("row_id", "doc_id", "text_key", F.posexplode("parts").alias("no", "part")).select(
        "row_id", "doc_id", "text_key", "no", F.length("part").cast("long").alias("length"),
        F.when(F.col("no") % 2 == 1, F.col("part")).alias("hit"),
        F.left("part", F.lit(CONTEXT_CHARS)).alias("head"), F.right("part", F.lit(CONTEXT_CHARS)).alias("tail"))
    order = Window.partitionBy("row_id").orderBy("no")
    near = cut.withColumns({
        "offset": F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "ahead": F.array_join(F.collect_list("tail").over(order.rowsBetween(-CONTEXT_PARTS, -1)), ""),
        "behind": F.array_join(F.collect_list("head").over(order.rowsBetween(1, CONTEXT_PARTS)), "")})
    # a value's name is a part of the hit
    return (near.filter("hit is not null").withColumn("name", F.regexp_extract("hit", f"^{KEYED}[\"']?", 0))
            .select("row_id", "no", "name", "doc_id", "text_key", (F.col("offset") + F.length("name")).alias("start"),
                    F.expr("substring(hit, length(name) + 1)").alias("candidate"),
                    F.expr(f"right(concat(ahead, name), {CONTEXT_CHARS})").alias("before"),
                    F.expr(f"left(behind, {CONTEXT_CHARS})").alias("after")))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): lower-case words of three or more letters."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).checkpoint()


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> DataFrame:
    """(word): words that make up at least ``share`` of all words of the corpus
    and stand there twice or more; at most 1 / share words."""
    return _common(word_counts(docs), share)


def _common(counts: DataFrame, share: float = DICTIONARY_SHARE) -> DataFrame:
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter((F.col("n") >= share * total) & (F.col("n") >= 2)).select("word")


def planted(counts: DataFrame, per_class: int = PLANTED_PER_CLASS) -> DataFrame:
    """Labelled findings (doc_id, text_key, start, candidate, before, after,
    label) made from at most ``per_class`` words of the corpus: one value of
    each label for each word (more for few words), both after the same
    credential word and mark.  Fewer than three words give none: a pass phrase
    takes as many."""
    words = counts.filter((F.length("word") <= 32) & (F.col("n") >= 2)).orderBy(F.xxhash64("word"), "word").limit(per_class).checkpoint()
    n = words.count()
    if n < 3:
        words, n = counts.filter(F.length("word") <= 32).orderBy(F.xxhash64("word"), "word").limit(per_class).checkpoint(), 0
        if (n := words.count()) < 3:
            words, n = words.limit(0), 1
    order = Window.orderBy(F.xxhash64("word"), "word")  # at most per_class rows
    near = (words.select("word", F.coalesce(F.lead("word", 1).over(order), F.lit("alpha")).alias("second"),
                         F.coalesce(F.lead("word", 2).over(order), F.lit("omega")).alias("third"))
            .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(min(500, per_class // n))))))

    def draw(salt: int, n: int) -> Column:
        return F.pmod(F.xxhash64("word", "copy", F.lit(salt)), F.lit(n)).cast("int")

    digest = F.sha2(F.concat_ws("/", "word", "copy"), 512)
    mixed = F.translate(F.base64(F.unhex(digest)), "+/=", "")
    upto = lambda c, low, high, salt: F.substring(c, F.lit(1), F.lit(low) + draw(salt, high - low + 1))
    digits = lambda low, high, salt: F.rpad(F.substring(
        F.regexp_replace(digest, "[a-f]", ""), F.lit(1), F.lit(low) + draw(salt, high - low + 1)), low, "7")
    secret = [upto(digest, 16, 64, 1), upto(mixed, 8, 40, 2), upto(F.translate(mixed, "aeiouAEIO", "!@#$%^&*?"), 6, 24, 3),
              *2 * [F.concat(upto(F.col("word"), 4, 8, 8), upto(F.col("second"), 4, 8, 9), upto(F.col("third"), 4, 8, 10))],
              F.concat("word", digits(1, 4, 4)),
              upto(F.translate(mixed, "0123456789", "qWzXvBnMkJ"), 12, 40, 5),
              F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.substring(digest, 13, 12)),
              F.concat(F.substring(F.translate(mixed, "0123456789", "qWzXvBnMkJ"), 1, 1), F.lit(" "), F.substring(mixed, 5, 1), digits(1, 2, 6)),
              F.concat(F.substring("word", 1, 1), digits(1, 3, 7))]
    harmless = [F.col("word"), F.initcap("word"), F.col("word"), digits(1, 6, 11), F.concat("word", F.lit("("), "second", F.lit(")")),
                F.concat(F.lit("https://"), "word", F.lit(".org/"), "second", F.lit("/"), "third", F.lit(".html")),
                F.concat("word", F.lit("."), "second"), F.concat("word", F.lit("_"), "second"), F.concat("word", F.lit("-"), "second"),
                F.initcap("word"), F.concat(F.lit("20"), F.lpad(digits(2, 2, 12), 2, "1"), F.lit("-0"), digits(1, 1, 13), F.lit("-1"), digits(1, 1, 14)),
                F.concat("word", F.lit("@"), "second", F.lit(".org"))]

    def pick(values: list[Column], salt: int) -> Column:
        return F.element_at(F.array(*values), 1 + draw(salt, len(values)))

    # the words that follow findings in prose are the common ones
    following = [F.lit(r["word"]) for r in counts.orderBy(F.desc("n"), "word").limit(50).collect()] or [F.lit("end")]
    name = pick([F.lit(w) for w in CREDENTIAL_WORDS], 21)
    mark = pick([F.lit(m) for m in (": ", " = ", "=", ': "', ' = "', "='")], 22)
    before = F.when(draw(23, 8) == 0, F.lit("Bearer ")).otherwise(F.concat("third", F.lit(" "), name, mark))
    after = F.concat(F.when(F.col("before").rlike("[\"\']$"), F.substring("before", -1, 1)).otherwise(F.lit("")), F.lit(" "), pick(following, 26))
    return near.withColumn("before", before).select(
        F.lit(None).cast("long").alias("doc_id"), F.xxhash64("word", "copy").alias("text_key"), F.length("before").cast("long").alias("start"),
        "before", after.alias("after"),
        F.explode(F.array(F.struct(pick(secret, 24).alias("candidate"), F.lit(1.0).alias("label")),
                          F.struct(pick(harmless, 25).alias("candidate"), F.lit(0.0).alias("label")))).alias("v")).select(
        "doc_id", "text_key", "start", "v.candidate", "before", "after", "v.label")


def describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the features that need no labels, and the neighbours."""
    c = F.col("candidate")
    n = F.length(c).cast("double")

    def share(kind: str):
        return F.length(F.regexp_replace(c, f"[^{kind}]", "")) / n

    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9"), "[^aA9]", "-")
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    pieces = F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))
    keys = [x for x in ("row_id", "no", "name", "doc_id", "text_key", "start", "candidate", "before", "after", "label")
            if x in found.columns]
    # a candidate's pieces meet the dictionary once for each distinct candidate
    covered = (found.select("candidate").distinct().select("candidate", F.explode(pieces).alias("word"))
               .join(F.broadcast(words), "word").groupBy("candidate")
               .agg(F.sum(F.length("word")).alias("covered")))
    return found.join(covered, "candidate", "left").select(
        *keys,
        F.lower(F.regexp_extract("before", r"([\p{L}_]+)[^\p{L}_\n]*$", 1)).alias("word_before"),
        F.lower(F.regexp_extract("after", r"^[^\p{L}_\n]*([\p{L}_]+)", 1)).alias("word_after"),
        F.log1p(n).alias("f_length"), ((runs - 1) / n).alias("f_changes"), share("0-9").alias("f_digits"),
        share("A-Z").alias("f_capitals"), share("0-9a-fA-F").alias("f_hex"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("f_distinct"),
        (F.coalesce("covered", F.lit(0)) / n).alias("f_dictionary"), share("/.@").alias("f_path"),
        F.col("before").rlike(r"[/@.\\]$").cast("double").alias("f_in_path"),
        F.col("before").rlike(ASSIGNED).cast("double").alias("f_assigned"),
        (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double").alias("f_quoted"))


def format_labels(described: DataFrame) -> DataFrame:
    """Findings labelled where their format alone settles it: 1 for known key
    formats, 0 for plain numbers, mail and network addresses and host names that
    no credential word assigns.  Others stay unlabelled and are left out."""
    assigned = (F.col("f_assigned") == 1) & F.col("word_before").rlike(
        rf"(^|_)({'|'.join(CREDENTIAL_WORDS)})s?(_|$)")
    return described.withColumn("label", F.when(F.col("candidate").rlike(KEY_FORMATS), 1.0).when(
        ~assigned & F.col("candidate").rlike(HARMLESS_FORMATS), 0.0)).filter("label is not null")


@dataclass
class SecretForest:
    """Trained forest with the neighbour rates; ``model`` None: no training data
    of both classes, then every finding counts as a secret."""

    model: object
    before: DataFrame | None
    after: DataFrame | None

    def with_rates(self, described: DataFrame) -> DataFrame:
        rows = described
        for side, rates in (("before", self.before), ("after", self.after)):
            rows = (rows.join(F.broadcast(rates.withColumnRenamed("word", f"word_{side}")
                                          .withColumnRenamed("rate", f"f_{side}")), f"word_{side}", "left")
                    .withColumn(f"f_{side}", F.coalesce(f"f_{side}", F.lit(0.5))))
        return rows

    def score(self, described: DataFrame) -> DataFrame:
        """``described`` with score (0 to 1) and predicted (1: secret)."""
        if self.model is None:
            return described.withColumn("score", F.lit(1.0)).withColumn("predicted", F.lit(1))
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(self.with_rates(described))
        return (self.model.transform(assembled).withColumn("score", vector_to_array("_probability")[1])
                .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
                .drop("_features", "_probability", "_raw", "_prediction", "f_before", "f_after"))


def train(labelled: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> SecretForest:
    """Forest from described findings with a ``label``; at most ``per_class`` of
    each class, the ones with the smallest hashes, so runs agree."""
    order = [F.xxhash64("doc_id", "start", "candidate"), F.col("candidate"), F.col("start")]
    sample = None
    for value in (0.0, 1.0):
        part = labelled.filter(F.col("label") == value).orderBy(*order).limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    sample = sample.checkpoint()
    if sample.select("label").distinct().count() < 2:
        return SecretForest(None, None, None)

    def rates(column: str) -> DataFrame:
        # at most 2 * per_class / MIN_NEIGHBOURS words
        return (sample.groupBy(F.col(column).alias("word"))
                .agg(F.count("*").alias("n"), ((F.sum("label") + 1) / (F.count("*") + 2)).alias("rate"))
                .filter(F.col("n") >= MIN_NEIGHBOURS).select("word", "rate").checkpoint())

    forest = SecretForest(None, rates("word_before"), rates("word_after"))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(forest.with_rates(sample))
    forest.model = RandomForestClassifier(
        featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction").fit(
            ready.select("_features", "label"))
    return forest


def scan(docs: DataFrame, labelled: DataFrame | None = None, mod: int = 5, held_out: int = 0) -> DataFrame:
    """(doc_id, text_key, start, candidate, before, after, features, score,
    predicted) of every finding in ``docs``.  ``labelled``: described findings
    with a label; by default those that `format_labels` settles in documents
    outside the held-out remainder, and the planted ones."""
    ensure_checkpoint_dir(docs.sparkSession)
    return _scan(candidates(docs), docs, labelled, mod, held_out)


def _scan(found: DataFrame, docs: DataFrame, labelled: DataFrame | None, mod: int = 5, held_out: int = 0) -> DataFrame:
    counts = word_counts(docs)
    words = _common(counts)
    described = describe(found.checkpoint(), words).checkpoint()
    if labelled is None:
        settled = format_labels(described.filter(id_crc_mod(F.col("doc_id"), mod) != held_out))
        made = describe(planted(counts).checkpoint(), words)
        shared = [c for c in made.columns if c in settled.columns]
        labelled = settled.withColumn("doc_id", F.col("doc_id").cast("string")).select(shared).unionByName(
            made.withColumn("doc_id", F.col("doc_id").cast("string")).select(shared))
    return train(labelled).score(described)


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[SECRET]``; all rows
    and columns come back, and texts without a secret are unchanged.

    Rows are written once with the parts that the pattern cut their texts into;
    only hits are shuffled, and a text is put together from its parts again."""
    ensure_checkpoint_dir(docs.sparkSession)
    cut = marked_parts(F.col("text"))
    rows = (docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("r"), "doc_id", F.xxhash64("text").alias("text_key"),
                        F.col("text"))
            .withColumn("parts", cut).withColumn("parts", F.when(F.size("parts") > 1, F.col("parts")))
            .drop("text").withColumn("row_id", F.monotonically_increasing_id()).checkpoint())
    scored = _scan(_candidates(rows.filter("parts is not null").drop("r")), rows.select("r.text"), labelled)
    hits = scored.select("row_id", "no", "candidate", (F.col("predicted") == 1).alias("secret"),
                         F.concat("name", F.when(F.col("predicted") == 1, F.lit(REDACTED)).otherwise(F.col("candidate"))).alias("new"))
    found = (hits.groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("no", "new"))).alias("_hits"),
        F.collect_set(F.when(F.col("secret") & (F.length("candidate") >= EVERYWHERE_CHARS), F.col("candidate"))).alias("_long"),
        F.max("secret").alias("_any")).filter("_any"))
    # text and hits by turns
    text = F.expr("""concat(array_join(transform(_hits, (h, i) -> concat(parts[2 * i], h.new)), ''), element_at(parts, -1))""")
    # longer ones first, so that one inside another is not cut up
    clean = F.aggregate(F.array_sort("_long", lambda a, b: F.length(b) - F.length(a)), text,
                        lambda t, s: F.replace(t, s, F.lit(REDACTED)))
    changed = (rows.filter("parts is not null").join(found, "row_id", "left")
               .withColumn("r", F.when(F.col("_hits").isNull(), F.col("r")).otherwise(F.col("r").withField("text", clean))))
    return rows.filter("parts is null").select("r.*").unionByName(changed.select("r.*"))
