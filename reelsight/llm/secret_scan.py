"""Secret scan: candidate strings, and a random forest that removes the false
positives.

Candidates are values assigned to a name that speaks of credentials, passwords
in urls, whole blocks of private keys, and strings of 16 or more key characters
with a letter and a digit.  The forest
sees length, character transitions, dictionary coverage, path features and the
neighbouring words of each candidate; it is trained on labelled findings
(columns before, name, value, after, label) and turned into one SQL
expression, so that scoring is a projection.

Only DataFrame functions and Spark's own forest are used.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelsight.llm.tables import counted_anew, packed, row_key, staged, unpacked

# Words of credential names, of other identifiers near long
# strings, prefixes of issued keys, and common words of identifiers.
CREDENTIAL = "token|secret|passwd|password|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential"
BENIGN = ("commit|revision|checksum|digest|sha1|sha256|sha512|md5|hash|uuid|guid|etag|integrity|version|build|image|"
          "layer|trace|span|session id|request id|order|invoice|isbn|tracking|file|path|url|href|src")
ISSUED = "^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abpr]-|sk_live_|sk-|rk_live_|AIza|ya29\\.|eyJ|npm_|SG\\.)"
PLACEHOLDER = "example|sample|dummy|placeholder|changeme|your|insert|replace|redacted|xxxx|1234567|abcdef|test|fake|todo|\\$\\{|\\*\\*\\*"
DICTIONARY = (
    "access account action active address admin agent alert amount android application array audio author backup "
    "balance banner base batch before block body branch browser buffer build button cache card cart category channel "
    "check class clear client close cloud cluster code color column command comment commit common company complete "
    "config connect contact content context control cookie copy count country create current custom data database "
    "date debug default delete delivery detail device direct display document domain double download email enable end "
    "engine entry error event example export failed feature field file filter first folder font form format frame "
    "from function gateway get global group handler header height hello history home host image import index info "
    "input insert internal invoice item job key label language last layer layout length level library limit link list "
    "local location login logo main manager map master media member menu message method mobile mode model module "
    "month name network new next node normal note number object offset online open option order output package page "
    "param parent password path payment phone photo picture plan platform player point policy port post price print "
    "private process product profile project public query queue random read record redirect region release remote "
    "report request reset resource response result return review role route rule sample save scale schema scope "
    "screen script search secret section secure select send server service session set share shop show size source "
    "start state static status step stock storage store stream string style submit success summary support switch "
    "system table task team template test text theme thread time title token tool total track type update upload "
    "user value version video view wait web week width window word work world write year zone").split()

KEY = "[A-Za-z0-9_+/=~-]"
ASSIGN = f"(?i:{CREDENTIAL})[A-Za-z0-9_-]*[\"']?\\s{{0,3}}(?:=>|=|:)\\s{{0,3}}[\"']?"
VALUE = "[^\\s\"'<>,;]{6,}"
BLOCK = ("-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:\\s{1,4}[A-Za-z-]{1,40}: [^\\n]{0,200}){0,4}"
         "[A-Za-z0-9+/=\\s]*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
USER = "://[^\\s/:@\"'<>]{1,64}:"
LOGIN = f"{USER}[^\\s/@\"'<>]{{4,}}(?=@[A-Za-z0-9\\[])"
PATTERN = f"{BLOCK}|{LOGIN}|{ASSIGN}{VALUE}|(?<!{KEY})(?={KEY}{{16}})(?={KEY}*[0-9])(?={KEY}*[A-Za-z]){KEY}{{16,}}"


@dataclass(frozen=True)
class Scan:
    trees: int = 20
    depth: int = 6
    limit: float = 0.5
    #: Labelled findings used for fitting, at most.
    max_rows: int = 6_000
    seed: int = 5
    context: int = 40


def named(found: Column) -> tuple[Column, Column]:
    """(name part, value part) of a match."""
    pattern = f"^(?:{ASSIGN}({VALUE})|{USER}([^\\s]+))$"
    value = F.concat(F.regexp_extract(found, pattern, 1), F.regexp_extract(found, pattern, 2))
    value = F.when(value == "", found).otherwise(value)
    return F.substring(found, F.lit(1), F.length(found) - F.length(value)), value


FEATURES = ("length", "transitions", "classes", "digits", "upper", "hex", "distinct", "dictionary", "vowels", "slashes",
            "dots", "path_before", "path_like", "credential", "credential_near", "benign_near", "quoted", "issued",
            "placeholder", "dashes", "repeats", "login", "block")


def features(before: Column, name: Column, value: Column, after: Column) -> dict[str, Column]:
    """The numbers the forest sees."""
    n = F.greatest(F.length(value), F.lit(1)).cast("double")

    def left_out(pattern: str) -> Column:
        """Characters that match the pattern."""
        return (F.length(value) - F.length(F.regexp_replace(value, pattern, ""))).cast("double")

    runs = value
    for pattern, one in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[^a-zA-Z0-9]+", "-")):
        runs = F.regexp_replace(runs, pattern, one)
    near = F.lower(F.concat(F.regexp_extract(before, "(\\S+\\s+\\S*)$", 1), name))
    flag = lambda c: c.cast("double")
    return {
        "length": n,
        "transitions": (F.length(runs) - 1) / n,
        "classes": sum((flag(value.rlike(p)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^a-zA-Z0-9]")), F.lit(0.0)),
        "digits": left_out("[0-9]") / n,
        "upper": left_out("[A-Z]") / n,
        "hex": left_out("[0-9a-f]") / n,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(64.0)),
        "dictionary": (n - F.length(F.regexp_replace(F.lower(value), "|".join(w for w in DICTIONARY if len(w) > 3), ""))) / n,
        "vowels": left_out("[aeiouAEIOU]") / n,
        "slashes": left_out("/"),
        "dots": left_out("[.]"),
        "path_before": flag(before.rlike("(?:[/\\\\]|://\\S*)$")),
        "path_like": flag(value.rlike("^(?:[~.]{0,2}/)?[A-Za-z_.-]+/[A-Za-z]|\\.[a-z]{2,4}$")),
        "credential": flag(name != ""),
        "credential_near": flag(near.rlike(f"(?:{CREDENTIAL})")),
        "benign_near": flag(near.rlike(f"(?:{BENIGN})\\W{{0,4}}\\S*$")),
        "quoted": flag(after.rlike("^[\"']")),
        "issued": flag(value.rlike(ISSUED)),
        "placeholder": flag(F.lower(value).rlike(PLACEHOLDER)),
        "dashes": left_out("[_-]"),
        "repeats": left_out("(.)(?=\\1)") / n,
        "login": flag(name.startswith("://")),
        "block": flag(value.startswith("-----BEGIN ")),
    }


def labelled_findings(spark: SparkSession, rows: int = 6_000) -> DataFrame:
    """Labelled findings to train on: before, name, value, after, label (1: a
    secret).  Secrets are random strings as credentials are issued, in the
    places where they leak; the others are what scanners report wrongly:
    digests, ids, paths, identifiers, placeholders, dates."""
    i = F.col("id")
    h = lambda s: F.sha2(F.concat(i.cast("string"), F.lit(s)), 256)
    b64 = lambda s: F.translate(F.base64(F.unhex(h(s))), "+/=", "aZ7")  # noqa: E731  43 letters and digits
    # one literal a list rather than one a word: thousands of them would fill the driver
    pick = lambda s, words: F.get(F.split(F.lit("\x1f".join(words)), "\x1f", -1),
                                  F.pmod(F.xxhash64(i, F.lit(s)), F.lit(len(words))).cast("int"))
    size = lambda s, lo, hi: (F.pmod(F.xxhash64(i, F.lit(s)), F.lit(hi - lo + 1)) + lo).cast("int")
    cut = lambda c, n: F.substring(c, F.lit(1), n)
    word = lambda s: pick(s, DICTIONARY)
    prose = pick("prose", ["the value of this ", "and then we ran ", "| a cell | ", "see the note: ", "", "line one\n",
                           "mit der ", "avec le ", "### ", "erth the of in "])
    after = pick("after", ['"', '" and more', '"### ', "' ", '";\n'])
    none = F.lit("")
    name = F.concat(pick("name", ["token", "secret", "password", "api_key", "apikey", "auth_token", "access_key",
                                  "client_secret", "private_key", "passwd"]),
                    pick("gap", [' = "', '="', ': "', '": "', "='", "="]))
    uuid = F.concat_ws("-", cut(h("u1"), F.lit(8)), cut(h("u2"), F.lit(4)), cut(h("u3"), F.lit(4)), cut(h("u4"), F.lit(4)),
                       cut(h("u5"), F.lit(12)))
    kinds = [  # (label, before, name, value, after)
        (1, prose, name, cut(h("a"), size("a", 32, 64)), after),
        (1, prose, name, cut(b64("b"), size("b", 16, 43)), after),
        (1, prose, none, F.concat(F.lit("AKIA"), F.upper(cut(F.translate(h("c"), "0189", "QRST"), F.lit(16)))), F.lit(" ")),
        (1, prose, none, F.concat(pick("d", ["ghp_", "sk_live_", "glpat-", "npm_", "AIza"]), cut(b64("d"), size("d", 24, 40))), F.lit("\n")),
        (1, prose, name, F.concat(word("e"), cut(b64("e"), size("e", 6, 12))), after),
        (1, F.concat(prose, F.lit("Authorization: Bearer ")), none, F.concat(F.lit("eyJ"), b64("f1")), F.lit(".")),
        (1, F.concat(prose, pick("g", ["key ", "use token ", "credential "])), none, cut(b64("g"), size("g", 28, 43)), F.lit(" ")),
        (0, F.concat(prose, pick("h", ["commit ", "sha256:", "md5 ", "checksum ", "revision ", "digest "])), none,
         cut(h("h"), pick("hs", ["40", "64", "32"]).cast("int")), F.lit(" ")),
        (0, F.concat(prose, pick("i", ["id ", "uuid=", "request id ", ""])), none, uuid, F.lit(" ")),
        (0, F.concat(prose, pick("j", ["https://www.example.com/", "/usr/share/", "src/", "path "])), none,
         F.concat_ws("/", word("j1"), F.concat(word("j2"), F.lit("_"), word("j3")), F.concat(word("j4"), size("j", 1, 99).cast("string"))), F.lit(".html")),
        (0, prose, none, F.concat_ws("_", word("k1"), word("k2"), word("k3"), F.concat(F.lit("v"), size("k", 1, 999).cast("string"))), F.lit("(")),
        (0, prose, name, F.concat(pick("l1", ["your_", "example_", "<insert_", "changeme_", "${", "xxxxxxxxxxxx", "test_"]), word("l2"),
                                  pick("l3", ["_here", "_here_123", "}", "1", "_value"])), after),
        (0, prose, none, F.concat(F.lit("2024-0"), size("m1", 1, 9).cast("string"), F.lit("-1"), size("m2", 0, 9).cast("string"),
                                  F.lit("T00-00-"), size("m3", 10, 59).cast("string"), F.lit("Z")), F.lit(" ")),
        (0, prose, name, F.concat_ws(".", F.lit("config"), word("n1"), word("n2")), F.lit("\n")),
        (0, prose, none, F.concat_ws("-", word("o1"), word("o2"), size("o", 1, 2030).cast("string"), word("o3")), F.lit("\n")),
        (0, F.concat(prose, pick("p", ["order ", "tracking ", "invoice ", "isbn "])), none,
         F.concat(F.upper(cut(word("p"), F.lit(2))), F.translate(h("p"), "abcdef", "012345")).substr(1, 18), F.lit(" ")),
    ]
    kinds += [
        (1, F.concat(prose, pick("q", ["postgres", "https", "mongodb+srv", "amqp"])), F.concat(F.lit("://"), word("q1"), F.lit(":")),
         F.concat(word("q2"), cut(b64("q"), size("q", 3, 20))), F.lit("@d")),
        (0, F.concat(prose, pick("r", ["postgres", "https", "redis"])), F.concat(F.lit("://"), word("r1"), F.lit(":")),
         pick("r2", ["password", "<password>", "${PASSWORD}", "your_password", "xxxxxxxx", "changeme", "example"]), F.lit("@h")),
        (1, prose, none, F.concat(F.lit("-----BEGIN "), pick("s", ["RSA ", "EC ", "OPENSSH ", ""]), F.lit("PRIVATE KEY-----\n"),
                                  pick("s0", ["", "", "Proc-Type: 4,ENCRYPTED\n\n"]),
                                  F.repeat(F.concat(b64("s1"), F.lit("\n")), size("sn", 1, 12)),
                                  F.repeat(F.concat(b64("s2"), cut(b64("s3"), F.lit(21)), F.lit("\n")), size("sm", 1, 20)),
                                  cut(b64("s4"), size("s", 4, 43)), F.lit("=\n-----END PRIVATE KEY-----")), F.lit("\n")),
        (1, prose, F.concat(pick("t", ["secret-key: ", "api-key=", "client-secret-value: \"", "access-token = "])),
         cut(b64("t"), size("t", 8, 24)), after),
    ]
    rec = [F.struct(F.lit(k).alias("label"), b.alias("before"), n.alias("name"), v.alias("value"), a.alias("after"))
           for k, b, n, v, a in kinds]
    one = F.get(F.array(*rec), F.pmod(i, F.lit(len(kinds))).cast("int"))
    return spark.range(0, rows, 1, 4).select(one.alias("r")).select("r.before", "r.name", "r.value", "r.after", "r.label")


def _tree_sql(lines: list[str], at: int, var: str) -> tuple[str, int]:
    """SQL of the subtree that starts at line ``at`` of a forest's text."""
    line = lines[at].strip()
    if line.startswith("Predict:"):
        return line.split(":")[1].strip(), at + 1
    m = re.match(r"If \(feature (\d+) <= ([-+.\dEe]+)\)", line)
    yes, nxt = _tree_sql(lines, at + 1, var)
    no, nxt = _tree_sql(lines, nxt + 1, var)  # the line of Else is skipped
    return f"CASE WHEN {var}.{FEATURES[int(m[1])]} <= {m[2]}D THEN {yes} ELSE {no} END", nxt


def train(findings: DataFrame, scan: Scan = Scan(), var: str = "f") -> str:
    """The forest as SQL over a struct ``var`` of :func:`features`: the share
    of trees that call a candidate a secret.

    At most ``max_rows`` findings with the least hash are used; null labels
    are left out.  One class alone gives a constant.  Their features are
    written: the fit reads its rows several times, and planning and compiling
    the features each time fills the driver's memory."""
    rows = findings.where("label is not null").select("label", *[
        c.alias(k) for k, c in features(*[F.coalesce(F.col(x), F.lit("")) for x in ("before", "name", "value", "after")]).items()])
    rows = rows.orderBy(F.xxhash64(*FEATURES, "label")).limit(scan.max_rows).withColumn("label", F.col("label").cast("double"))
    rows = staged(rows, "secret-features")
    classes = [r[0] for r in rows.select("label").distinct().orderBy("label").collect()]
    if len(classes) < 2:
        return str(classes[0] if classes else 0.0)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows).select("label", "x")
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=scan.trees, maxDepth=scan.depth,
                                    seed=scan.seed).fit(data)
    lines = [x for x in forest.toDebugString.splitlines() if x.strip()]
    starts = [i + 1 for i, x in enumerate(lines) if x.strip().startswith("Tree ")]
    return "(" + " + ".join(f"({_tree_sql(lines, at, var)[0]})" for at in starts) + f") / {float(len(starts))}D"


def _candidates(docs: DataFrame, forest: str, scan: Scan, text: str) -> DataFrame:
    """``docs`` with _pieces (what is between matches) and _found (name,
    value, score of each match); null where there is no match."""
    t = F.col(text)
    hit = docs.withColumn("_raw", F.when(t.rlike(PATTERN), F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0))))
    hit = hit.withColumn("_pieces", F.when(F.col("_raw").isNotNull(), F.split(t, PATTERN, -1)))

    def seen(raw: Column, i: Column) -> Column:
        name, value = named(raw)
        return F.struct(F.get("_pieces", i).alias("before"), name.alias("name"), value.alias("value"),
                        F.get("_pieces", i + 1).alias("after"))

    hit = hit.withColumn("_seen", F.transform("_raw", seen)).drop("_raw")

    def judged(x: Column) -> Column:
        tail = F.substring(x["before"], -scan.context, scan.context)
        f = features(tail, x["name"], x["value"], F.substring(x["after"], 1, 2))
        return F.struct(x["name"].alias("name"), x["value"].alias("value"),
                        F.struct(*[c.cast("double").alias(k) for k, c in f.items()]).alias("f"))

    hit = hit.withColumn("_seen", F.transform("_seen", judged))
    score = re.sub(r"\bf\.", "x.f.", forest)
    return hit.withColumn("_found", F.expr(
        f"transform(_seen, x -> named_struct('name', x.name, 'value', x.value, 'score', CAST({score} AS DOUBLE)))")).drop("_seen")


def findings(docs: DataFrame, forest: str, scan: Scan = Scan(), text: str = "text") -> DataFrame:
    """(doc_id, start, end, named, n_chars, value_sha256, score, secret) of
    every candidate: where its value stands in the text (code points, end
    exclusive), whether a credential name precedes it, and the verdict.  The
    value itself is not repeated.

    Null and empty texts have no candidates; null ids are passed on; repeated
    rows have their findings each; an empty table gives no rows."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("_t"))
    c = _candidates(d.where(F.col("_t").rlike(PATTERN)), forest, scan, "_t").drop("_t")
    rows = c.withColumn("_row", F.monotonically_increasing_id()).select(
        "_row", "doc_id", F.posexplode(F.arrays_zip(
            F.transform(F.slice("_pieces", 1, F.size("_found")), lambda p: F.length(p)).alias("skip"), F.col("_found").alias("c"))))
    rows = rows.select("_row", "doc_id", "pos", F.col("col.skip").alias("skip"), F.col("col.c").alias("c"))
    size = F.length(F.col("c.name")) + F.length(F.col("c.value"))
    upto = F.sum(F.col("skip") + size).over(Window.partitionBy("_row").orderBy("pos"))
    return rows.withColumn("end", upto.cast("long")).select(
        "doc_id", (F.col("end") - F.length("c.value")).alias("start"), "end", (F.col("c.name") != "").alias("named"),
        F.length("c.value").cast("long").alias("n_chars"), F.sha2(F.col("c.value"), 256).alias("value_sha256"),
        F.col("c.score").alias("score"), (F.col("c.score") > scan.limit).alias("secret"))


def redact(docs: DataFrame, forest: str, scan: Scan = Scan(), text: str = "text", length: str = "n_chars",
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret replaced by ``mark`` (``length``, if there is
    such a column, counted anew where the text changed).  No row goes."""
    rows = packed(docs, row_key(F.col("doc_id")))
    c = _candidates(rows.select("row", F.col("row")[text].alias("_t")), forest, scan, "_t")
    hits = F.coalesce(F.exists("_found", lambda x: x["score"] > scan.limit), F.lit(False))
    parts = F.transform("_found", lambda x, i: F.concat(
        F.get("_pieces", i), x["name"], F.when(x["score"] > scan.limit, F.lit(mark)).otherwise(x["value"])))
    clean = F.concat(F.array_join(parts, ""), F.get("_pieces", F.size("_found")))
    made = c.select("row", hits.alias("hits"), F.when(hits, clean).otherwise(F.col("_t")).alias("now"))
    return unpacked(made, docs, {text: F.col("now")} | counted_anew(docs, text, length, F.col("now"), F.col("hits")))
