"""Secret scans by linking the parts of a credential.

Three kinds of finding stand on their own: an assignment to a secret's name, an access identifier and a long
hexadecimal string. Other strings look like parts of a credential but are weak evidence alone: account names, opaque
tokens and endpoints. A weak candidate is reported only if a part that complements it starts within ``reach`` code
points of it, in the same scope. A scope is a block of text between blank lines.

The interval join is a window over the parts of one scope, with a frame of ``reach`` code points on either side.
Matches of one kind do not overlap, so a frame holds a bounded number of parts and the work is linear, however many
parts a text has. Texts are read once, and only parts travel: no pairs, no second scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trendcast.llm.shared import text_or_empty

# The kinds that count alone, as pattern, the group that is measured, and its least length.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
# Weak candidates. An opaque token also needs a digit and letters of both cases.
WEAK = {
    "account": (r"""(?i:username|user|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]+""", 0, 8),
    "opaque": (r"[A-Za-z0-9+/_-]{20,}", 0, 20),
    "endpoint": (r"(?:https?|ftp|ssh|postgresql|postgres|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+", 0, 8),
}
KINDS = (*BASE, *WEAK)
# The kinds that make a weak candidate worth reporting.
COMPLEMENTS = {"account": ("assign", "hex", "opaque"), "opaque": ("access", "account", "endpoint"),
               "endpoint": ("assign", "hex", "opaque")}
SCOPE_BREAK = r"\n[\x20\x09\x0D]*\n"
ANY_PART = "|".join(f"(?:{pattern})" for pattern, _, _ in (BASE | WEAK).values())


def _matches(text: Column, kind: str) -> Column:
    """Matches of one kind in order: number, code points since the match before, code points it spans, whether it counts."""
    pattern, group, least = (BASE | WEAK | {"break": (SCOPE_BREAK, 0, 0)})[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    each = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("span"), measured.alias("measured"))

    def row(m, i):
        counts = F.length(m["measured"]) >= least
        if kind == "opaque":
            counts = counts & m["span"].rlike("[0-9]") & m["span"].rlike("[a-z]") & m["span"].rlike("[A-Z]")
        return F.struct(F.lit(kind).alias("kind"), i.alias("no"), F.length(m["gap"]).alias("gap"),
                        F.length(m["span"]).alias("span"), counts.alias("counts"))

    return F.filter(F.transform(each, row), lambda m: m["span"].isNotNull())


def parts(docs: DataFrame) -> DataFrame:
    """Every part of every whole text: (row_id, doc_id, kind, start, end, scope), offsets in code points, end exclusive.

    Each document also has one row with a null kind. ``row_id`` tells rows with the same id apart.
    """
    text = text_or_empty(docs)
    nothing = F.array().cast("array<struct<kind:string,no:int,gap:int,span:int,counts:boolean>>")
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", text.alias("text"))
    text = F.col("text")
    found = F.when(text.rlike(ANY_PART), F.concat(*[_matches(text, k) for k in (*KINDS, "break")])).otherwise(nothing)
    # A row without a kind keeps the document.
    found = F.concat(found, F.array(F.lit(None).cast("struct<kind:string,no:int,gap:int,span:int,counts:boolean>")))
    rows = rows.select("row_id", "doc_id", F.explode(found).alias("m")).select("row_id", "doc_id", "m.*")
    upto = Window.partitionBy("row_id", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    in_text = Window.partitionBy("row_id").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    return (
        rows.repartition("row_id")
        .withColumn("end", F.sum(F.col("gap") + F.col("span")).over(upto))
        .withColumn("start", F.col("end") - F.col("span"))
        .withColumn("scope", F.count(F.when(F.col("kind") == "break", 1)).over(in_text))
        .where("kind is null or (counts and kind != 'break')")
        .select("row_id", "doc_id", "kind", "start", "end", "scope")
    )


def findings(found: DataFrame, reach: int = 300) -> DataFrame:
    """The parts worth reporting: all base findings, and weak candidates with a complement within ``reach``.

    A weak candidate that overlaps a base finding is that finding, not a part of its own.
    """
    kind = F.col("kind")
    base = kind.isin(*BASE)
    text = Window.partitionBy("row_id").orderBy("start")
    behind, ahead = text.rangeBetween(Window.unboundedPreceding, 0), text.rangeBetween(0, Window.unboundedFollowing)
    near = Window.partitionBy("row_id", "scope").orderBy("start").rangeBetween(-reach, reach)
    free = ((F.coalesce(F.max(F.when(base, F.col("end"))).over(behind), F.lit(-1)) <= F.col("start"))
            & F.coalesce(F.min(F.when(base, F.col("start"))).over(ahead) >= F.col("end"), F.lit(True)))
    alone = found.withColumn("free", free).where(kind.isNull() | base | F.col("free"))
    linked = F.lit(False)
    for weak, others in COMPLEMENTS.items():
        linked = linked | ((kind == weak) & (F.count(F.when(kind.isin(*others), 1)).over(near) > 0))
    return alone.withColumn("linked", linked).where(kind.isNull() | base | F.col("linked")).drop("free", "linked")


def scan(docs: DataFrame, reach: int = 300) -> DataFrame:
    """One row per document: its findings as an array of structs (start, kind_no, end, kind), in order.

    A null or empty text has no findings. Other columns of ``docs`` are not looked at.
    """
    number = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    rows = findings(parts(docs), reach)
    return rows.groupBy("row_id", "doc_id").agg(F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct(
        F.col("start"), number.alias("kind_no"), F.col("end"), F.col("kind"))))).alias("findings"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
