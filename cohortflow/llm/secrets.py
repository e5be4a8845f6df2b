"""Secret scanning with a random forest that removes false positives.

DataFrame operations and Spark ML only.  A cheap pattern finds candidates (long
opaque runs of letters, digits and base64 signs, and any value of 6 or more
characters that is assigned to a secret's name or stands in user:value@host); cutting the text at the same
pattern yields each candidate's left and right neighbours.  Features: length,
character classes, character transitions, coverage by dictionary words, path
signs and neighbouring words.  A random forest trained on labelled findings
decides which candidates are secrets.

Labelled findings: pass ``findings`` (left, candidate, right, label).  Without
one, findings are labelled by rule from a bounded sample (``SAMPLE``) of the real
candidates: values assigned to a secret's name and known forms are secrets, numbers,
identifiers and joined words are not, and the rest is left out.  As many findings,
whatever the table, are written from templates of known secret and look-alike forms.

Defined results: null and empty texts have no candidates; repeated rows and
null ids are scanned like any other row; an empty table gives no findings, and
a sample without candidates still trains on the templates.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.session import materialize

#: Real candidates that are labelled, at most, half of them of each label.
SAMPLE = 4000
#: Tasks that share the rows of one text when it is redacted.
SALTS = 8
# Names of secrets, names of harmless identifiers, frequent words.
SECRET_NAMES = r"(?i)(token|secret|passw|passphrase|pwd|api[ _-]?key|access[ _-]?key|auth|bearer|credential|private[ _-]?key)"
HARMLESS_NAMES = r"(?i)(commit|sha[0-9]*|md5|checksum|digest|hash|uuid|guid|etag|revision|build|order|card|phone|serial|isbn|page|anchor)"
_ASSIGNMENT = SECRET_NAMES + r"""[A-Za-z_ -]{0,12}["']?\s{0,3}(=|:|=>|:=)\s{0,3}["']?"""
ASSIGNED = _ASSIGNMENT + "$"
_USER = r"""(?:^|[\s"'/(<=])[A-Za-z0-9._%+-]{1,40}:"""
#: Candidates of the first form: 16 or more characters with a digit, or 24 or more without.
OPAQUE = r"(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}|[A-Za-z+/_-]{24,})={0,2}"
#: Of the second form: the value of 6 or more characters after an assignment to a secret's name (up
#: to the closing quote if quoted, else without closing punctuation), or before the @ of user:value@host.
#: The short look-behinds only spare the long ones their work.
VALUE = (
    r"""(?<=[=:>]\s{0,3}["']?)(?<=(?:""" + _ASSIGNMENT + r"""))(?-i)(?:(?<=")[^\s"]{6,}|(?<=')[^\s']{6,}|(?<!["'])[^\s"'=>:]\S{4,}[^\s"'.,;:!?)\]}>])"""
    r"|(?<=:)(?<=" + _USER + r")[^\s/]{6,}(?=@[A-Za-z0-9\[])"
)
CANDIDATE = f"(?:{VALUE}|{OPAQUE})"
#: Ordinary words, as they stand after "author:" or "token:" in prose.
PLAIN_WORD = r"^(?:\p{Lu}?\p{Ll}+|\p{Lu}+)(?:[-'’.,]\p{L}\p{Ll}*)*$"
#: Whole secrets of known form, wherever they stand.
KNOWN_FORM = (
    r"^/*(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|glpat-[A-Za-z0-9_-]{16,}|xox[abp]-[A-Za-z0-9-]{16,}|[sr]k_live_[A-Za-z0-9]{16,}|"
    r"sk-(?=\S*[0-9])(?=\S*[A-Z])[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{30,}|npm_[A-Za-z0-9]{30,}|hf_[A-Za-z0-9]{30,}|eyJ[A-Za-z0-9_-]{16,})"
)
#: Look-alikes by their own form: numbers, lines of signs, UUIDs, words joined by signs.
LOOK_ALIKE = (
    r"^(?:[0-9+/_-]+=*|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|"
    r"[/_+-]*(?:[A-Z]?[a-z]{2,}[0-9]{0,4}|[0-9]{1,4})(?:[/_+-]+(?:[A-Z]?[a-z]+[0-9]{0,4}|[0-9]{1,4}))+[/_+-]*)$"
)
#: The name of a harmless identifier right before.
CALLED_HARMLESS = HARMLESS_NAMES + r"""[A-Za-z_ ]{0,8}["']?\s{0,3}[:=#(]?\s{0,3}["']?$"""
DICTIONARY = (
    "the and that with have this from they would there their what about which when make like time just know take into year your good some could them "
    "other than then look only come over think also back after work first well even want because these give most der die und ist nicht ein eine mit "
    "auf den von sich des les une est pour que dans qui sur pas par plus los las una para con por del file path test data user page index image "
    "example default content tion ment ing heit keit lich schaft cion mente able ness over under inter"
).split()

FEATURES = [
    "length", "digits", "upper", "lower", "hex_only", "signs", "class_changes", "vowels", "consonant_runs", "repeats", "alternation",
    "dictionary", "slashes", "path_left", "url_left", "assigned", "secret_left", "harmless_left", "quoted", "word_left", "digit_only", "prefix_form", "userinfo", "mail_left", "plain_word",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n, start, candidate, left, right) of every candidate.

    ``start`` is the 0-based offset of the candidate, ``n`` its number in the text.  Each
    candidate leaves its document with its neighbours and the length of the gap before it;
    the offsets are running sums over a document's candidates, so the work is in
    proportion to the text, however many candidates it has.
    """
    text = F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.monotonically_increasing_id().alias("row"), text.alias("t"), found.alias("found"))
    d = d.filter(F.size("found") > 0).withColumn("parts", F.split("t", CANDIDATE, -1)).drop("t")
    zipped = F.arrays_zip("found", F.slice("parts", F.lit(1), F.size("found")).alias("before"), F.slice("parts", F.lit(2), F.size("found")).alias("after"))
    one = F.transform(
        zipped,
        lambda z, i: F.struct(
            i.alias("n"), z["found"].alias("candidate"), F.length(z["before"]).cast("bigint").alias("gap"),
            F.right(z["before"], F.lit(40)).alias("left"), F.substring(z["after"], 1, 16).alias("right"),
        ),
    )
    e = d.select("doc_id", "text_key", "row", F.inline(one))
    so_far = Window.partitionBy("row").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("start", (F.sum(F.col("gap") + F.length("candidate")).over(so_far) - F.length("candidate")).cast("int"))
    return e.select("doc_id", "text_key", "n", "start", "candidate", "left", "right")


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def with_features(found: DataFrame) -> DataFrame:
    """Feature columns of ``found`` (candidate, left, right), all doubles."""
    c, left = F.col("candidate"), F.col("left")
    n = F.length(c).cast("double")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    words = r"(?i)(?:" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")"
    columns = {
        "length": F.least(n, F.lit(200.0)),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "hex_only": _flag(c.rlike("^[0-9a-fA-F]+$")),
        "signs": share("[+/_=-]"),
        "class_changes": share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"),
        "vowels": share("[aeiouAEIOU]"),
        "consonant_runs": share("[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{4}"),
        "repeats": share(r"(.)\1"),
        "alternation": share("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"),
        "dictionary": F.lit(1.0) - F.length(F.regexp_replace(c, words, "")) / n,
        "slashes": share("/"),
        "path_left": _flag(left.rlike(r"[/\\.]$")),
        "url_left": _flag(left.rlike(r"(?i)(https?://|www\.)\S*$")),
        "assigned": _flag(left.rlike(r"""(=|:)\s{0,3}["']?$""")),
        "secret_left": _flag(left.rlike(SECRET_NAMES)),
        "harmless_left": _flag(left.rlike(HARMLESS_NAMES)),
        "quoted": _flag(left.rlike("[\"'`]$") & F.col("right").rlike("^[\"'`]")),
        "word_left": _flag(left.rlike(r"(?<![A-Za-z])[a-z]{2,} $")),
        "digit_only": _flag(c.rlike("^[0-9-]+$")),
        "prefix_form": _flag(c.rlike("^/*(AKIA|ASIA|ghp_|gho_|glpat-|xox[abp]-|sk-|sk_live_|rk_live_|eyJ|AIza|npm_|hf_)")),
        "userinfo": _flag(left.rlike("://[^\\s/:@]+:$") & F.col("right").rlike("^@")),
        "mail_left": _flag(left.rlike("(?i)(mailto|mail|contact|from|to|cc):$") & F.col("right").rlike("^@")),
        "plain_word": _flag(c.rlike(PLAIN_WORD)),
    }
    return found.select("*", *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(f"f_{k}") for k, v in columns.items()])


def _templates(ids: DataFrame) -> DataFrame:
    """(left, candidate, right, label): known forms filled with hashes of ids."""
    sha = lambda salt, bits=256: F.sha2(F.concat_ws(":", F.lit(salt), F.col("doc_id").cast("string")), bits)
    b64 = lambda salt: F.regexp_replace(F.base64(F.unhex(sha(salt))), "=", "")
    digits = F.lpad(F.abs(F.xxhash64(F.lit("n"), "doc_id")).cast("string"), 18, "4")
    uuid = F.regexp_replace(F.substring(sha("u"), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    word = lambda k: F.element_at(F.array(*[F.lit(w) for w in DICTIONARY]), (F.pmod(F.xxhash64(F.lit(k), "doc_id"), F.lit(len(DICTIONARY))) + 1).cast("int"))
    letters = lambda salt, n: F.substring(F.regexp_replace(F.concat(b64(salt), b64(salt + "2")), "[^A-Za-z]", ""), 1, n)
    joined = F.concat(*[word(k) for k in range(6)])
    path = F.concat_ws("/", *[word(k) for k in range(10, 15)])
    forms = [
        ('token = "', F.substring(sha("a"), 1, 40), '"', 1),
        ("secret: ", b64("b"), " ", 1),
        ("api_key='", F.substring(sha("c"), 1, 32), "'", 1),
        ("password = ", F.substring(b64("d"), 1, 24), "\n", 1),
        ("the ", F.concat(F.lit("AKIA"), F.upper(F.substring(F.regexp_replace(b64("e"), "[+/]", "Q"), 1, 16))), " ", 1),
        ("git clone ", F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(b64("f"), "[+/]", "x"), 1, 36)), "@", 1),
        ("Authorization: Bearer ", F.concat(F.lit("eyJ"), b64("g")), ".", 1),
        ('password = "', F.concat(word(20), F.substring(sha("l"), 1, 4), word(21)), '"', 1),
        ("password: ", F.concat(F.initcap(word(22)), F.lit("@"), F.substring(sha("m"), 1, 4), F.lit("!#"), F.substring(b64("o"), 1, 8)), " ", 1),
        ("api_key=", letters("p", 18), "\n", 1),
        ("postgres://app:", F.concat(word(23), F.substring(b64("q"), 1, 7)), "@db", 1),
        ("author: ", F.initcap(F.concat(word(24), word(25))), " ", 0),
        ("the token: ", F.concat(word(26), word(27), word(28)), " ", 0),
        ("mailto:", F.concat(word(29), F.lit("."), word(30)), "@", 0),
        ("http://localhost:", F.concat(F.lit("8080"), word(31)), "@", 0),
        ("commit ", F.substring(sha("h"), 1, 40), "\n", 0),
        ("md5: ", F.substring(sha("i"), 1, 32), " ", 0),
        ("sha256:", sha("j"), " ", 0),
        ("id=", uuid, "&", 0),
        ("and the ", digits, " of", 0),
        ("card: ", digits, ".", 0),
        ("the ", joined, " of", 0),
        ("the ", F.concat(joined, F.pmod("doc_id", F.lit(100)).cast("string")), ", ", 0),
        ("see ", path, " ", 0),
        ("https://www.example.com/", F.concat(path, F.lit("/"), F.substring(sha("k"), 1, 8)), " ", 0),
        ("\n", F.lit("-" * 40), "\n", 0),
    ]
    rows = F.array(*[F.struct(F.lit(a).alias("left"), c.alias("candidate"), F.lit(r).alias("right"), F.lit(float(y)).alias("label")) for a, c, r, y in forms])
    return ids.select(F.inline(rows))


def labelled_findings(found: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(left, candidate, right, label, weight) labelled by rule, at most ``sample`` real ones.

    Secrets: values assigned to a secret's name, and known forms anywhere.  Not
    secrets: look-alikes by form or name.  Other candidates teach nothing.  Per label,
    the real findings together weigh at most as much as the templates, however many.
    """
    c, left = F.col("candidate"), F.col("left")
    given = left.rlike(ASSIGNED) | (left.rlike("://[^\\s/:@]+:$") & F.col("right").rlike("^@"))
    # Words of prose may follow such a name; digits, other signs or mixed case make a value.
    sure = c.rlike(KNOWN_FORM) | (given & c.rlike("[A-Za-z]") & ~c.rlike(PLAIN_WORD))
    prose = c.rlike(PLAIN_WORD) & ~left.rlike("[=\"']$|=\\s+$")  # quoted or after "=" it may be a password
    alike = prose | (~given & (c.rlike(LOOK_ALIKE) | left.rlike(CALLED_HARMLESS)))
    rows = found.select("left", "candidate", "right", F.when(sure, 1.0).when(alike, 0.0).alias("label"))
    order = (F.xxhash64(F.lit(13), "candidate", "left"), "candidate", "left", "right")
    real = materialize(rows.filter("label = 1").orderBy(*order).limit(sample // 2).unionByName(rows.filter("label = 0").orderBy(*order).limit(sample // 2)))
    ids = sample // 20
    templates = _templates(found.sparkSession.range(ids).withColumnRenamed("id", "doc_id"))
    # Two rows at most each: the size of a label's templates and of its real findings.
    total = {r["label"]: r["n"] for r in templates.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    number = {r["label"]: r["n"] for r in real.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    each = {y: total[y] / (number.get(y, 0) + ids) for y in (0.0, 1.0)}
    weight = F.when(F.col("label") == 1, F.lit(each[1.0])).otherwise(F.lit(each[0.0]))
    return real.withColumn("weight", weight).unionByName(templates.withColumn("weight", F.lit(1.0)))


def train(findings: DataFrame, trees: int = 24, depth: int = 8) -> RandomForestClassificationModel | None:
    """Random forest over the findings; None if they hold fewer than two labels."""
    if "weight" not in findings.columns:
        findings = findings.withColumn("weight", F.lit(1.0))
    # Written in one fixed order: the bootstrap draws the same rows on every run.
    f = materialize(with_features(findings).coalesce(1).sortWithinPartitions("candidate", "left", "right"))
    if f.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(f).select("features", "label", "weight")
    return RandomForestClassifier(weightCol="weight", numTrees=trees, maxDepth=depth, seed=5, subsamplingRate=1.0).fit(data)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, text_key, n, start, candidate, left, right, score, is_secret) of every candidate."""
    found = materialize(candidates(docs, id_col, text_col))
    model = train(findings if findings is not None else labelled_findings(found))
    if model is None:
        return found.withColumn("score", F.lit(0.0)).withColumn("is_secret", F.lit(False))
    data = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(with_features(found))
    scored = model.transform(data).withColumn("score", F.round(vector_to_array("probability")[1], 9))
    return scored.select("doc_id", "text_key", "n", "start", "candidate", "left", "right", "score", (F.col("score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found secret replaced by ``mark`` where it stands; same rows and columns.

    The decision belongs to the place: the same characters elsewhere in the text stay.
    Decisions are joined by a hash of the text; copies of one text are dealt to ``SALTS``
    tasks by it.
    """
    every = scan(docs, id_col, text_col).groupBy("text_key", "n").agg(F.max("is_secret").alias("hit"))
    hits = every.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("n", "hit"))).alias("flags"), F.max("hit").alias("any")).filter("any")
    hits = hits.select("text_key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.transform("flags", lambda x: x["hit"]).alias("flags"))
    # The row travels as one struct, so that no name of it can clash.
    text = F.col(f"row.`{text_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.xxhash64(text).alias("text_key"), (F.monotonically_increasing_id() % F.lit(SALTS)).cast("int").alias("salt"))
    joined = rows.join(hits, ["text_key", "salt"], "left")
    found, parts = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.split(text, CANDIDATE, -1)
    pieces = F.arrays_zip(found.alias("c"), F.col("flags").alias("hit"), F.slice(parts, F.lit(2), F.size("flags")).alias("after"))
    rest = F.transform(pieces, lambda z: F.concat(F.when(z["hit"], F.lit(mark)).otherwise(z["c"]), z["after"]))
    clean = F.when(F.col("flags").isNull(), text).otherwise(F.concat(F.element_at(parts, 1), F.array_join(rest, "")))
    return joined.select(*[clean.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
