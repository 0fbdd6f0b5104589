"""Secret scan: candidates by shape, a random forest against false positives.

A candidate is a run of 16 or more letters, digits and ``_+/.-`` (``=`` at its
end) with a digit, inside a word of the whole text; or, of any length and any
characters, what a name such as ``password`` is assigned (``NAME=value``, ``NAME: value``,
``NAME = "value"``; of a value with white space its first word).  A name before ``=`` is no part of the value.  Its
features are length, character transitions and classes, dictionary coverage (letters in
pieces that occur as whole words of the corpus besides this value), signs of a path, and the words
around it.  The forest (Spark ML) learns from labelled findings and scores
every candidate.

Without labelled findings of the caller's own, the forest learns from written
examples (:func:`examples`: secrets of many shapes; digests, ids, references,
placeholders, paths that look like them) and from the corpus' clear cases: a value with a digit assigned to a name such as ``token``, one
with a provider's prefix or a user's password in an address is a secret; a digest or id that the word before calls so, a reference, a
placeholder, an address, a path, a number or a value made of dictionary pieces is none; the rest is only scored.  For half of the corpus' training
findings the words around are blanked, so that the forest also learns the shape of a secret.  At most ``TRAINING`` of them
are learned from, at most half of them of each label.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstat.llm.common import WORD, small, text_or_empty, written

TRAINING = 20_000
TREES = 30
DEPTH = 8
_BODY = r"[A-Za-z0-9_+/.\-]"
# Padding ends a value; what goes on after it, or in an opening quote, shows that a name stood before the sign.
_PAD_END = r"""(?![A-Za-z0-9]|["'`][^\s,;)\]}>&:])"""
RUN = rf"[A-Za-z0-9](?:{_BODY}{{14,}}={{1,2}}{_PAD_END}|{_BODY}{{13}}=={_PAD_END}|{_BODY}{{14,}}[A-Za-z0-9])"
# Names that secrets are assigned to, and prefixes that providers give them.
NAMES = r"(?i)(token(?!iz|is)|secret(?!ar)|passw(?!ordless)|passphrase|pwd|api.?key|auth(?!or(?!i[sz]))|credential|bearer|private|access.?key)"
SCHEMES = r"(?i)^[\"'`]?(bearer|basic|digest|token)$"
DIGESTS = r"(?i)(?<![a-z])(commit|sha-?[0-9]*|md5|hash|checksum|digest|revision|rev|blob|etag|integrity|uuid|guid|fingerprint|crc|object|build|trace|request|session|id)(?![a-z])"
PLACEHOLDER = r"(?i)\$[\w{(]|\{\{|^<|>$|%[({s]|\*{3}|x{4}|\.{3}|^(your|my|some|the)[_\-]|(?<![a-z0-9])example$|changeme|placeholder|redacted|dummy|^(none|null|true|false|undefined|todo)$"
REFERENCE = r"^[A-Za-z_$][\w.$]*(?:\(|\[|\{|->|::)"
PREFIX = r"^(AKIA|ASIA|gh[pousr]_|github_pat_|sk-|sk_live_|xox[abprs]-|AIza|glpat-|eyJ)"
_NAME = rf"(?:{NAMES.replace('(?i)(', '(?i:', 1)})[\w.\-]{{0,64}}[\"'`\])]{{0,3}}"
_SIGN = r"(?:={1,3}>?|:=|:(?!:))"
_ASSIGN = rf"(?<![\w.\-])(?<!//)[\w.\-]{{0,64}}?{_NAME}{_SIGN}[\"'`]?"
_PLAIN = r"""[^"'`&<>]+(?:&(?![\w.\-]+=)[^"'`&<>]+){0,50}"""
_GIVEN = rf"""(?<=")[^"]+|(?<=')[^']+|(?<=`)[^`]+|(?<!["'`]){_PLAIN}"""
# The password in an address that names a user.
_USER = r"""(?<=://)[^\s:/@"'`<>]*+:"""
IN_ADDRESS = r"""://[^\s:/@"'`<>]*+:[^@/\s"'`<>]++@"""
# Groups: 1 the value that a name is assigned, 2 an address' password, 3 a run, 4 the next character.  It goes on where the last
# match ended and nowhere else, so a word is read once, however long.
FIND = (
    rf"\G(?s).*?(?:{_ASSIGN}(?!{_ASSIGN[len(r'(?<![\w.\-])(?<!//)'):]})({_GIVEN})|{_USER}([^@/\s\"'`<>]++)(?=@)"
    rf"|(?:(?<![\w.\-])[A-Za-z_][\w.\-]{{0,200}}=[\"'`]?)?({RUN}))(?=(.?))"
)
WHOLE = r"(?<![\p{L}\p{N}_])[a-z]{3,}(?![\p{L}\p{N}_])"
SHAPE = [
    "length", "digits", "upper", "letter_digit", "case_change", "variety", "vowels", "hex", "only_digits", "dictionary", "slashes", "dots", "address",
    "brackets", "marks", "dashes",
]
AROUND = ["named", "assigned", "quoted", "digested", "user", "inline"]
EXAMPLES = 1800  # written lines that are learned from besides the corpus


def candidates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, position, before2, before, word, head, value, span): position is the word's place in its text.

    ``head`` is what stands before the value in its word, from the value before on; ``span`` is the value with its neighbouring characters.
    Columns of ``keep`` are passed on.
    """
    kept = documents.select(F.col(doc_id).alias("doc_id"), *keep, text_or_empty(text).alias("t"))
    words = kept.select("doc_id", *keep, F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("words"), F.col("t").rlike(NAMES).alias("names"))
    each = words.select("doc_id", *keep, "words", "names", F.posexplode("words").alias("position", "word"))
    before2 = F.when(F.col("position") > 1, F.get("words", F.col("position") - 2))
    before = F.when(F.col("position") > 0, F.get("words", F.col("position") - 1))
    prior = F.concat_ws(" ", before2, before)
    ends = reduce(lambda c, sign: c | F.endswith(F.coalesce(before, F.lit("")), F.lit(sign)), "=:>\"'`", F.lit(False))
    starts = F.col("word").startswith("=") | F.col("word").startswith(":")
    # What a scheme such as "Bearer" introduces, and what a name "is" (with a digit: "is required" is no value).
    said = before.rlike("(?i)^(is|was|as)$") & before2.rlike(rf"{_NAME}$") & F.col("word").rlike("[0-9]")
    scheme = before.rlike(SCHEMES) & F.coalesce(before2, F.lit("")).rlike(rf"{_NAME}{_SIGN}?[\"'`]?$")
    assigned = (ends & prior.rlike(rf"{_NAME}\s?{_SIGN}[\"'`]?$")) | F.coalesce(said | scheme, F.lit(False))
    signed = starts & prior.rlike(rf"{_NAME}$")
    run = (F.length("word") >= 16) & F.col("word").rlike(RUN)
    kept = each.where(run | (F.col("names") & (F.col("word").rlike(_ASSIGN) | assigned | signed)) | F.col("word").rlike(IN_ADDRESS))
    # A name that stands in a word before is put at the front, and taken off the head again.
    front = F.when(assigned, F.lit("password=")).when(signed, F.lit("password")).otherwise(F.lit(""))
    near = kept.select("doc_id", *keep, "position", "word", before2.alias("before2"), before.alias("before"), front.alias("front"))
    marked = F.concat("front", "word")
    # All groups of all matches in one reading: no word holds a tab or a line feed, so these part them.
    groups = ("match", "given", "password", "run", "next")
    matches = F.split(F.regexp_replace(marked, F.lit(FIND), F.lit("\t".join(f"${g}" for g in range(len(groups))) + "\n")), "\n")
    near = near.select("*", F.posexplode(F.slice(matches, 1, F.size(matches) - 1)).alias("turn", "part"))
    near = near.withColumn("part", F.split("part", "\t", -1))
    near = near.withColumn("part", F.struct(*[F.get("part", i).alias(n) for i, n in enumerate(groups)]))
    plain = F.regexp_replace("part.given", r"(?<![,;.)\]}])[,;.)\]}]+$", "")
    near = near.select("*", F.expr("left(part.match, length(part.match) - length(concat(part.given, part.password, part.run)))").alias("lead"))
    near = near.select("*", F.when(F.expr("right(lead, 1)").isin('"', "'", "`"), F.col("part.given")).otherwise(plain).alias("assigned"))
    own = F.concat("part.password", "part.run")
    value = F.when(F.col("part.given") != "", F.col("assigned")).otherwise(own)
    head = F.when(F.col("turn") == 0, F.expr("substring(lead, length(front) + 1)")).otherwise(F.col("lead"))
    # A run of only letters is a word, or not to be told from one; one before "=" is a name.
    name = (F.col("part.next") == "=") & F.col("part.run").rlike(r"^[A-Za-z][\w.\-]*$")
    given = F.col("assigned").rlike(r"[\p{L}\p{N}]") & ~F.col("assigned").rlike(SCHEMES)
    valid = F.when(F.col("part.given") != "", given).otherwise((F.col("part.password") != "") | (F.col("part.run").rlike("[0-9]") & ~name))
    span = F.concat(F.expr("right(lead, 1)"), "part.given", own, "part.next")
    return near.where(valid).select("doc_id", *keep, "position", "word", "before2", "before", head.alias("head"), value.alias("value"), span.alias("span"))


def _pieces(value):
    return F.regexp_extract_all(F.lower(value), F.lit("[a-z]{3,}"), F.lit(0))


def dictionary(documents: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """Rows (piece, times): letter runs of candidates that are whole words somewhere in the corpus, and how often."""
    pieces = written(found.select(F.explode(_pieces(F.col("value"))).alias("piece")).distinct(), "pieces")
    words = documents.select(F.explode(F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(WHOLE), F.lit(0))).alias("piece"))
    return words.join(small(pieces), "piece", "left_semi").groupBy("piece").agg(F.count(F.lit(1)).alias("times"))


def examples(spark: SparkSession) -> DataFrame:
    """Written lines (doc_id, text, known) with one candidate each: 1 secret, 0 none.

    They show what a corpus may have too little of: digests, ids, references and placeholders that look like
    secrets, and secrets of many shapes.
    """
    i, h = F.col("id"), F.sha2(F.col("id").cast("string"), 512)
    mixed = F.regexp_replace(F.base64(F.unhex(h)), "[+/=]", "")
    number = F.conv(F.substr(h, F.lit(100), F.lit(8)), 16, 10).cast("long")
    pick = lambda *a: F.element_at(F.array(*[F.lit(x) for x in a]), ((number + i) % len(a) + 1).cast("int"))
    cut = lambda text, a, least, most: F.substr(text, F.lit(a), (number % (most - least + 1) + least).cast("int"))
    uuid = F.concat_ws("-", *[F.substr(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    words = pick("river", "green", "summer", "monkey", "silver", "castle", "orange", "winter")
    password = F.concat(words, pick("!", "#", "_", "@", ""), cut(mixed, 5, 2, 6), number % 1000)
    name = pick("token", "api_key", "SECRET_KEY", "password", "db.password", "AUTH_TOKEN", "client_secret", "access_key", "private_key", "passwd")
    sign = pick(" = \"", "=", ": ", "='", ": \"", "=\"", " := \"")
    end = F.when(sign.contains('"'), '"').when(sign.contains("'"), "'").otherwise("")
    known = lambda label, *parts: (label, F.concat(*parts))
    named = lambda value: (name, sign, value, end)
    kinds = [
        known(1, *named(cut(mixed, 1, 20, 44))), known(1, *named(F.substr(h, F.lit(1), pick("32", "40", "64").cast("int")))),
        known(1, *named(password)), known(1, *named(cut(mixed, 3, 8, 14))),
        known(1, F.lit("Authorization: Bearer "), cut(mixed, 1, 24, 60)), known(1, pick("AKIA", "ASIA"), F.upper(F.substr(mixed, F.lit(1), F.lit(16)))),
        known(1, pick("ghp_", "sk_live_", "glpat-", "xoxb-"), cut(mixed, 1, 24, 36)),
        known(1, pick("postgres", "mysql", "amqp", "https"), F.lit("://"), words, F.lit(":"), password, F.lit("@db.host/x")),
        known(1, F.lit("the "), pick("password", "token", "secret"), F.lit(" is "), password),
        known(0, pick("commit ", "revision ", "merge commit ", "blob "), F.substr(h, F.lit(1), F.lit(40))),
        known(0, pick("sha256:", "sha256: ", "checksum ", "digest=", "hash: "), F.substr(h, F.lit(1), F.lit(64))),
        known(0, pick("md5 ", "md5=", "etag: ", "md5sum: "), F.substr(h, F.lit(1), F.lit(32))),
        known(0, pick("id ", "uuid: ", "request_id=", "trace ", "guid "), uuid), known(0, pick("seen ", "see ", "at "), uuid),
        known(0, F.lit("src=\"data:image/png;base64,"), F.substr(F.base64(F.unhex(h)), F.lit(1), F.lit(80)), F.lit('"')),
        known(0, F.lit("integrity=\"sha512-"), F.base64(F.unhex(h)), F.lit('"')),
        known(0, *named(pick("identifier", "string", "username", "required", "bearer_type", "file_path", "text/plain", "optional", "enabled"))),
        known(0, name, F.lit(" = "), pick("os.environ[\"KEY_1\"]", "getpass.getpass(1)", "request.headers[\"X-2\"]", "config.get('v2')", "settings.KEYS[0]", "vault::read(3)", "self->key2(0)")),
        known(0, *named(F.concat(pick("${", "$(", "{{", "%(", "<"), F.upper(words), F.lit("_"), number % 100, pick("}", ")", "}}", ")s", ">")))),
        known(0, *named(pick("your_api_key_1", "changeme123", "xxxxxxxx1", "********1", "YOUR-TOKEN-2", "example", "my_secret_1", "REDACTED0"))),
        known(0, pick("version ", "build ", "file "), words, F.lit("-"), number % 90, F.lit("."), number % 77, F.lit(".1-release")),
        known(0, pick("order ", "phone ", "ref "), F.lpad(number.cast("string"), 16, "4")),
        known(0, F.lit("path /usr/"), words, F.lit("/lib2/share/"), words, F.lit("/v1")),
        known(0, F.lit("mail "), words, F.lit(".reader"), number % 99, F.lit("@post.example.com")),
    ]
    line = F.array(*[F.struct(F.lit(label).alias("known"), text.alias("text")) for label, text in kinds])
    lines = spark.range(EXAMPLES).select(F.element_at(line, (i % len(kinds) + 1).cast("int")).alias("r"))
    return lines.select(F.lit(None).cast("string").alias("doc_id"), "r.text", "r.known")


def described(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The candidates of ``documents`` and of the examples with their features, as a written table.

    ``known`` is the label of an example's candidate, null in candidates of ``documents``.
    """
    own = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("int").alias("known"))
    kind = own.schema["doc_id"].dataType
    more = examples(documents.sparkSession).select(F.col("doc_id").cast(kind).alias("doc_id"), "text", "known")
    found = candidates(own, keep=("known",)).unionByName(candidates(more, keep=("known",)))
    found = written(found, "candidates")
    known = written(dictionary(documents, found, text), "dictionary")
    values = found.select("value").distinct()
    # A value's own places do not make its pieces words.
    own = found.where("known is null").select("value", F.explode(F.regexp_extract_all(F.lower("span"), F.lit(WHOLE), F.lit(0))).alias("piece"))
    own = own.groupBy("value", "piece").agg(F.count(F.lit(1)).alias("own"))
    covered = (
        values.select("value", F.explode(_pieces(F.col("value"))).alias("piece"))
        .join(small(known), "piece")
        .join(own, ["value", "piece"], "left")
        .where(F.col("times") > F.coalesce("own", F.lit(0)))
        .groupBy("value")
        .agg(F.sum(F.length("piece")).alias("letters"))
    )
    v, n = F.col("value"), F.length("value").cast("double")

    def share(pattern: str):
        return F.regexp_count(v, F.lit(pattern)) / n

    rows = found.join(covered, "value", "left")
    head = F.col("head")
    context = F.concat_ws(" ", "before2", "before", head)
    said = F.col("before").rlike("(?i)^(is|was|as)$") | F.col("before").rlike(SCHEMES)
    return written(
        rows.withColumns(
            {
                "length": n, "digits": share("[0-9]"), "upper": share("[A-Z]"),
                "letter_digit": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
                "case_change": share("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
                "variety": F.size(F.array_distinct(F.split("value", ""))) / n, "vowels": share("[aeiouAEIOU]"),
                "hex": v.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"), "only_digits": v.rlike("^[0-9]+$").cast("double"),
                "dictionary": F.coalesce("letters", F.lit(0)) / n, "slashes": share("/"), "dots": share("[.]"),
                "address": (F.col("word").rlike(r"@[\w\-]+\.|://") & ~head.rlike(r"://[^/@]*:$")).cast("double"),
                "brackets": share(r"[(){}<>$%\[\]]"), "marks": share(r"[^\p{L}\p{N}]"), "dashes": share("-"),
                "named": context.rlike(NAMES).cast("double"),
                "assigned": (F.concat_ws(" ", "before", head).rlike(r"[=:]>?\s*[\"'`]?\s*$") | F.coalesce(said, F.lit(False))).cast("double"),
                "quoted": head.rlike("[\"'`]$").cast("double"),
                "digested": context.rlike(DIGESTS).cast("double"), "user": head.rlike(r"://[^/@]*:$").cast("double"),
                "inline": head.rlike(r"base64,$|sha[0-9]+-$").cast("double"),
            }
        ),
        "described",
    )


def clear_cases(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label``: 1 secret, 0 none, null unclear.

    Deciding are the examples' own labels, the words around a value and forms that no secret has.
    """
    wordy = (F.col("digits") == 0) & (F.col("dictionary") >= 0.5)
    form = F.col("value").rlike(PLACEHOLDER) | F.col("value").rlike(REFERENCE)
    provider = F.col("value").rlike(PREFIX) & ~form
    digest = ((F.col("digested") == 1) & ((F.col("hex") == 1) | (F.col("dashes") > 0)) | (F.col("inline") == 1)) & (F.col("named") == 0)
    given = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("only_digits") == 0) & (F.col("digits") > 0) & (F.col("digested") == 0)
    secret = (provider | given | (F.col("user") == 1)) & (F.col("dictionary") < 0.5) & ~form
    none = (F.col("address") == 1) | (F.col("only_digits") == 1) | (F.col("dictionary") >= 0.5) | (F.col("slashes") >= 0.1)
    clear = F.when(secret, 1).when(form | digest | wordy | (none & (F.col("named") == 0)), 0)
    return rows.withColumn("label", F.coalesce("known", clear))


def train(labelled: DataFrame):
    """A forest from rows with features and ``label`` (1, 0, null); None unless both labels are there."""
    # Hashes in place of the values: however long a value, a row of the sample has the same few bytes.
    narrow = labelled.where("label is not null").select(
        *SHAPE, *AROUND, "label", "known", F.xxhash64("value").alias("h"), F.xxhash64("value", "doc_id", "position").alias("place")
    )
    # Half of the sample for each label: one that is rare in the corpus is not crowded out by the other.
    first = lambda label: narrow.where((F.col("label") == label) & F.col("known").isNull()).orderBy("place", "h").limit(TRAINING // 2)
    # One order for both: the forest depends on the order of its rows.
    sample = first(1).unionByName(first(0)).unionByName(narrow.where("known is not null")).orderBy("place", "h").limit(TRAINING + EXAMPLES)
    # What stands around is blanked in half of the corpus' own findings, which it gave their labels.
    blank = (F.pmod("h", F.lit(2)) == 0) & F.col("known").isNull()
    sample = written(sample.withColumns({c: F.when(blank, 0.0).otherwise(F.col(c)) for c in AROUND}), "training")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=17, probabilityCol="probability"
    )
    return forest.fit(_vectors(sample).select("features", F.col("label").cast("double").alias("label")))


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[*SHAPE, *AROUND], outputCol="features").transform(rows)


def secret_findings(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", findings: DataFrame | None = None
) -> DataFrame:
    """Rows (doc_id, position, value, score, predicted), one per candidate in ``documents``.

    ``findings`` (value, label) gives the caller's own labelled findings, which alone are then learned from; without, the
    examples and the corpus' clear cases are.  Null and empty texts have no candidates; repeated rows have
    theirs repeatedly.  If the caller's findings do not have both labels, the score is the finding's own, 0 where there is none.
    """
    rows = described(documents, doc_id, text)
    if findings is None:
        labelled = clear_cases(rows)
    else:
        labels = findings.groupBy("value").agg(F.max("label").alias("label"))
        labelled = rows.where("known is null").join(labels, "value", "left")
    model = train(labelled)
    labelled = labelled.where("known is null")
    if model is None:
        score = F.coalesce(F.col("label").cast("double"), F.lit(0.0))
        scored = labelled.withColumn("score", score)
    else:
        scored = model.transform(_vectors(labelled)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", F.col("position").cast("long").alias("position"), "value", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
