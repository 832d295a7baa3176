"""Secret scans with multipart credential linking, in DataFrame functions only.

Three base kinds are reported wherever they match: assignments, access ids and
hex runs.  Three weak kinds (logins, opaque strings, endpoints) are reported
only when complementary parts stand within `scope` code points: a login with a
secret, an opaque string with an identifier, an endpoint with an identifier and
a secret.  That test is an interval join: each part goes to the buckets of its
document that its scope touches, and parts meet in the bucket where one starts.
Spans of one kind don't overlap, so a bucket holds a bounded number of them.

Positions are code points, end exclusive.  They follow from the lengths of the
matches and of the pieces between them.

Defined results: null and empty texts have no spans; each row is a document of its
own, whatever its id; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

KEYWORDS = r"[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = rf"""(?:{KEYWORDS})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = rf"""^(?:{KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BLOCK = 256
BASE = ["assign", "access", "hex"]
WEAK = ["login", "opaque", "endpoint"]
#: Runs of the least length start and end where runs of any length would.
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "login": r"""(?:[Uu]ser(?:name)?|[Ll]ogin|client_id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    "opaque": r"[A-Za-z0-9+/_-]{20,}",
    "endpoint": r"[a-z]{2,12}://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+",
}


def spans(text: Column, kind: str) -> Column:
    """Array of (start, end, value) of a kind's matches, leftmost and not overlapping."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(found, F.slice(pieces, F.lit(1), F.size(found)), lambda m, p: F.struct(F.length(p).alias("gap"), m.alias("value")))
    entries = "array<struct<start:int,end:int,value:string>>"

    def add(done: Column, step: Column) -> Column:
        begin = done["at"] + step["gap"]
        end = begin + F.length(step["value"])
        entry = F.struct(begin.alias("start"), end.alias("end"), step["value"].alias("value"))
        return F.struct(F.concat(done["out"], F.array(entry)).alias("out"), end.alias("at"))

    def add_block(done: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(F.array().cast(entries).alias("out"), done["at"].alias("at")), add)
        return F.struct(F.concat(done["out"], F.array(inner["out"])).alias("out"), inner["at"].alias("at"))

    # in blocks, so that a text with very many matches doesn't copy one long array for each of them
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)))
    placed = F.aggregate(blocks, F.struct(F.array().cast(f"array<{entries}>").alias("out"), F.lit(0).alias("at")), add_block, lambda done: F.flatten(done["out"]))
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast(entries))


def parts(docs: DataFrame) -> DataFrame:
    """row, doc_id and an array of (kind, start, end) of every candidate, checked alone; `row` tells rows apart once it is written."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    checks = {
        "assign": lambda v: F.length(F.regexp_extract(v, ASSIGN_VALUE, 1)) >= 12,
        "opaque": lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]"),
    }
    out = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    out = out.select("row", "doc_id", *[spans(F.col("text"), kind).alias(kind) for kind in PATTERNS])
    arrays = []
    for k, kind in enumerate(PATTERNS):  # the lambdas are called at once, so they may use the loop's names
        kept = F.filter(kind, lambda x: checks[kind](x["value"])) if kind in checks else F.col(kind)
        arrays.append(F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end"))))
    return out.select("row", "doc_id", F.concat(*arrays).alias("parts"))


def _listed(part: Column) -> Column:
    names = F.array(*[F.lit(k) for k in PATTERNS])
    return F.array_join(F.transform(F.array_sort(part), lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def linked(found: DataFrame, scope: int) -> DataFrame:
    """row and the weak parts that complementary parts support, as an array."""
    kinds = list(PATTERNS)
    role = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "id", "login": "id", "endpoint": "place"}
    code = F.create_map(*[F.lit(x) for k, kind in enumerate(kinds) for x in (k, role[kind])])
    weak = [kinds.index(k) for k in WEAK]
    mixed = F.size(F.array_distinct(F.transform("parts", lambda x: F.element_at(code, x["kind"])))) > 1
    useful = found.where(F.exists("parts", lambda x: x["kind"].isin(weak)) & mixed)
    rows = useful.select("row", F.explode("parts").alias("p")).select("row", "p.*").withColumn("role", F.element_at(code, F.col("kind")))
    near = rows.withColumn("bucket", F.explode(F.sequence(F.floor(F.greatest(F.col("start") - scope, F.lit(0)) / scope), F.floor((F.col("end") + scope) / scope))))
    near = near.select("row", "bucket", F.col("start").alias("near_start"), F.col("end").alias("near_end"), F.col("role").alias("near_role"))
    home = rows.where(F.col("kind").isin(weak)).withColumn("bucket", F.floor(F.col("start") / scope))
    met = home.join(near, ["row", "bucket"]).select("row", "start", "kind", "end", "role", "near_start", "near_end", "near_role")
    # apart, within the scope of each other, and of another role
    met = met.where("role <> near_role and near_start - end <= {0} and start - near_end <= {0} and (near_end <= start or near_start >= end)".format(scope))
    support = met.groupBy("row", "start", "kind", "end").agg(F.bool_or(F.col("near_role") == "id").alias("id"), F.bool_or(F.col("near_role") == "secret").alias("secret"))
    wanted = F.when(F.col("kind") == kinds.index("login"), F.col("secret")).when(F.col("kind") == kinds.index("opaque"), F.col("id")).otherwise(F.col("id") & F.col("secret"))
    return support.where(wanted).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))


def scan_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """n_assign, n_access, n_hex, base_sha256 and spans of every document row."""
    found = written(parts(docs), "secret-parts")
    both = found.join(linked(found, scope), "row", "left")
    base = F.filter("parts", lambda x: x["kind"] < len(BASE))
    count = lambda k: F.size(F.filter("parts", lambda x: x["kind"] == k)).cast("long")
    everything = F.concat(base, F.coalesce(F.col("more"), F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return both.select(
        "doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(everything).alias("spans"),
    )
