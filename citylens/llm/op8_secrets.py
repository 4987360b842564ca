"""Secret scans with multipart credential linking (DataFrame functions only).

Base spans come from three fixed patterns.  On top of them weak parts are
collected: identifiers (``login = ...``, or a base access key), secrets (short
or oddly named values, or a base assignment) and endpoints (URLs with a
scheme, ``host = ...``).  Parts are intervals; an interval join within a text
pairs parts whose starts are at most ``SCOPE`` code points apart (equal cell of
``SCOPE`` code points or a neighbour, then the distance).  A weak secret is
reported only if an identifier co-occurs, a weak identifier only with a secret,
an endpoint only with both.

The parts of equal texts are joined once: they are keyed by the text's SHA-256.
Positions of matches follow from the lengths of the pieces between them.

Defined results: NULL text is empty; no span gives the SHA-256 of the empty
string and an empty list; a NULL id is an ordinary row; repeated rows each get
their row; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylens.llm.common import materialise, text_or_empty

# The base patterns, their least lengths and the kinds in the order listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 18
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "login", "weak", "endpoint"]

# The weak parts.
LOGIN = r"""(?i:(user(name)?|login|account|client_?id|access_?key(_?id)?))["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
WEAK = r"""(?i:(password|passwd|pwd|passphrase|secret|token|api_?key|auth|credentials?))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}"""
ENDPOINT = r"""(?i:(https?|ftp|ssh|s3|jdbc:[a-z]+|postgres(ql)?|mysql|mongodb|redis|amqps?)://[^\x00-\x20"'<>]+|(host|hostname|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9][A-Za-z0-9.-]+)"""
SCOPE = 200

_SPANS = "array<struct<s:int,k:int,e:int>>"


def _spans(text: Column, pattern: str, kind: str, if_any: Column, group: int = 0, least: int = 0) -> Column:
    """Spans of all matches: starts are sums of the pieces between and the matches before."""
    rx = F.lit(pattern)
    found, rank = F.regexp_extract_all(text, rx, F.lit(0)), F.lit(KINDS.index(kind))
    sized = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("p"), F.transform(found, F.length).alias("m"),
                         F.transform(F.regexp_extract_all(text, rx, F.lit(group)), F.length).alias("g"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["p"]
        span = F.struct(begin.alias("s"), rank.alias("k"), (begin + x["m"]).alias("e"))
        grown = F.when(x["g"] >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct((begin + F.coalesce(x["m"], F.lit(0))).alias("at"), grown.alias("out"))

    spans = F.aggregate(sized, start, add, lambda acc: acc["out"])
    return F.when(if_any & text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _role(kind: Column) -> Column:
    """id for access and login, secret for assign and weak, endpoint."""
    return (F.when(kind.isin(KINDS.index("access"), KINDS.index("login")), "id")
            .when(kind == KINDS.index("endpoint"), "endpoint").otherwise("secret"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, assign, access, hex, parts)``; text_key only where parts may complement each other."""
    text = F.col("text")
    marks = (F.instr(text, "=") > 0) | (F.instr(text, ":") > 0)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).select(
        "doc_id", "text", _spans(text, ASSIGN, "assign", marks, 2, ASSIGN_VALUE).alias("assign"),
        _spans(text, ACCESS, "access", F.instr(text, "AKIA") > 0, 0, ACCESS_LENGTH).alias("access"),
        _spans(text, HEX, "hex", F.lit(True)).alias("hex"), _spans(text, LOGIN, "login", marks).alias("login"),
        _spans(text, WEAK, "weak", marks).alias("weak"))
    complete = (F.size("login") + F.size("access") > 0) & (F.size("weak") + F.size("assign") > 0)
    weak = F.filter("weak", lambda w: ~F.exists("assign", lambda a: a["s"] == w["s"]))
    parts = F.concat("access", "login", "assign", weak, _spans(text, ENDPOINT, "endpoint", marks))
    return rows.select("doc_id", "assign", "access", "hex", F.when(complete, F.unhex(F.sha2("text", 256))).alias("text_key"),
                       F.when(complete, parts).alias("parts"))


def linked(scanned: DataFrame) -> DataFrame:
    """Weak parts that complementary parts support: ``(text_key, added)`` spans per text."""
    parts = (scanned.where("text_key is not null").select("text_key", F.explode("parts").alias("x"))
             .select("text_key", "x.s", "x.k", "x.e").distinct()
             .withColumn("role", _role(F.col("k"))).withColumn("cell", F.expr(f"s div {SCOPE}")))
    others = parts.where("role <> 'endpoint'").select(
        "text_key", F.col("role").alias("o_role"), F.col("s").alias("o_s"),
        F.explode(F.array(*[F.col("cell") + d for d in (-1, 0, 1)])).alias("cell"))
    weak = parts.where(F.col("k") >= KINDS.index("login"))
    near = weak.join(others, ["text_key", "cell"]).where(F.abs(F.col("s") - F.col("o_s")) <= SCOPE)
    told = near.groupBy("text_key", "s", "k", "e", "role").agg(
        F.bool_or(F.col("o_role") == "id").alias("with_id"), F.bool_or(F.col("o_role") == "secret").alias("with_secret"))
    kept = told.where(((F.col("role") == "secret") & F.col("with_id")) | ((F.col("role") == "id") & F.col("with_secret"))
                      | ((F.col("role") == "endpoint") & F.col("with_id") & F.col("with_secret")))
    return kept.groupBy("text_key").agg(F.collect_list(F.struct("s", "k", "e")).alias("added"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    scanned = materialise(scan(docs, id_col, text_col), "secrets")
    # rows without parts have no key: they do not join, or all of them would meet in one partition
    added = F.array().cast(_SPANS).alias("added")
    both = (scanned.where("text_key is not null").join(linked(scanned), "text_key", "left").select(*scanned.columns, "added")
            .unionByName(scanned.where("text_key is null").select("*", added)))
    base = F.concat("assign", "access", "hex")
    return both.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.concat(base, F.coalesce("added", F.array().cast(_SPANS)))).alias("spans"))
