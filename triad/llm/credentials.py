"""Secrets in texts, judged by how many owners hold the same value.

Only DataFrame functions: one scan finds the candidates of every kind with their
places, as arrays beside the row.  A candidate's value is hashed; over the whole
corpus each hash is counted by distinct repositories and distinct owners.  A value
that more than ``most_owners`` owners hold is an example that people copy; one that
looks live and belongs to fewer is a credential.  The base kinds (assignments,
access keys, long hexadecimal numbers) are always reported; the further kinds
(vendor tokens, signed tokens, private keys, URLs with a password, bearer headers,
other named values, opaque strings) only where ownership says credential.

Places come from the pieces between matches: a match begins where the pieces and
matches before it end, in code points.  Counting combines on the map side at each
of its three steps (value, owner, repository), so a value copied into a third of
all rows is no hot key; verdicts go back by ``spread_join``.

An owner is a ``source`` and a repository a document, unless the caller names other
columns.  Null owners and repositories count as one each.

Defined results.  Null text is empty.  Every row, repeated or not, gets its own
result.  Offsets are code points, ends exclusive.  A further candidate that
touches a base span or one of an earlier kind is not a span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triad.llm.common import cut, documents, spread_join

# Kinds: name, pattern, the pattern's group that holds the value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 2), ("access", r"AKIA[A-Z0-9]{16,}", 0), ("hex", r"[0-9a-f]{24,}", 0))
MORE = (
    ("vendor", r"(gh[oprsu]_|github_pat_|glpat-|[rs]k_live_|xox[abeoprs]-|AIza|ASIA|npm_|pypi-)[A-Za-z0-9_-]{16,}", 0),
    ("signed", r"eyJ[A-Za-z0-9_-]{8,256}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0),
    ("key", r"-----BEGIN [A-Z0-9\x20]{0,30}PRIVATE KEY( BLOCK)?-----[^-]{32,}-----END [A-Z0-9\x20]{0,30}PRIVATE KEY( BLOCK)?-----", 0),
    ("url", r"""[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D/:@"'<>]{1,64}:([^\x20\x09-\x0D/:@"'<>]{6,256})@""", 1),
    ("bearer", r"((?i:bearer|basic))\x20+([A-Za-z0-9+/_.~=-]{16,})", 2),
    ("named", r"((?i:pwd|credentials?|(client|app|access|auth|private|session|consumer)[_-]?(key|id)))"
              r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})""", 4),
    ("opaque", r"[A-Za-z0-9_-]{20,}", 0),
)
KINDS = tuple(k for k, _, _ in BASE + MORE)
SHORTEST = 6                     # of an assigned value
MOST_OWNERS = 2
LEAST_LETTERS = 8                # different characters of a value that looks live
# Parts of values that stand for a secret without being one.
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|redacted|your[_-]|xxxx|\*\*\*|0{6}|123456|abcdef"


def looks_live(value: Column) -> Column:
    """Digits and letters, LEAST_LETTERS different characters, no placeholder."""
    different = F.size(F.array_distinct(F.array_remove(F.split(value, ""), "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= LEAST_LETTERS) & ~value.rlike(PLACEHOLDER)


def placed(text: Column, matches: Column, pattern: str, kind: str, group: int) -> Column:
    """array<struct<start, kind, end, value>> of the matches of one kind, by start."""
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(F.char_length(p).alias("gap"), F.char_length(m).alias("size"), m.alias("match")))
    spot = "struct<start:long,kind:int,end:long,value:string>"
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{spot}>").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        value = F.regexp_extract(p["match"], pattern, group) if group else p["match"]
        one = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + p["size"]).alias("end"), value.alias("value"))
        return F.struct((start + p["size"]).alias("at"), F.concat(acc["out"], F.array(one.cast(spot))).alias("out"))

    found = F.when(F.size(matches) > 0, F.aggregate(pairs, zero, step, lambda acc: acc["out"])).otherwise(F.array().cast(f"array<{spot}>"))
    return F.filter(found, lambda s: F.char_length(s["value"]) >= SHORTEST) if kind == "assign" else found


def apart(spans: Column, others: Column) -> Column:
    """The ``spans`` that touch none of ``others``."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """row_key, doc_id, owner, repository, base and more (arrays of struct<start, kind, end, hash, live>)."""
    d = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{owner}`").cast("string").alias("owner"), F.col(f"`{repository}`").cast("string").alias("repository"))
    kinds = BASE + MORE
    d = d.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p, _ in kinds])
    d = d.select("doc_id", "owner", "repository", *[placed(F.col("text"), F.col(f"m_{k}"), p, k, g).alias(k) for k, p, g in kinds])
    d = d.withColumn("base", F.array_sort(F.concat(*[k for k, _, _ in BASE])))
    d = d.withColumn("more", F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>"))
    for k, _, _ in MORE:
        live = F.filter(k, lambda s: looks_live(s["value"]))
        d = d.withColumn("more", F.when(F.size(k) > 0, F.concat("more", apart(apart(live, F.col("base")), F.col("more")))).otherwise(F.col("more")))

    def hashed(spans: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                                                     F.sha2(s["value"].cast("binary"), 256).alias("hash"), looks_live(s["value"]).alias("live")))

    return d.select(F.monotonically_increasing_id().alias("row_key"), "doc_id", "owner", "repository",
                    hashed("base").alias("base"), hashed("more").alias("more"))


def ownership(each: DataFrame) -> DataFrame:
    """hash, owners, repositories and rows of the candidates ``each`` (hash, owner, repository)."""
    one = each.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("rows"))
    one = one.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("rows").alias("rows"))
    return one.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("rows").alias("rows"))


def secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", most_owners: int = MOST_OWNERS) -> DataFrame:
    """One row per document: doc_id, base (array<struct<start, kind, end>>), spans (base and added),
    and how many of the spans are live (owned by few) and how many copied (held by many)."""
    found = cut(candidates(docs, owner, repository))
    each = found.select("row_key", "owner", "repository", F.explode(F.concat("base", "more")).alias("s"))
    each = cut(each.select("row_key", "owner", "repository", "s.*"))
    owned = cut(ownership(each))
    judged = spread_join(each.drop("owner", "repository"), owned, ["hash"], "rows", each.count())
    few = F.col("owners") <= most_owners
    added = F.col("kind") >= len(BASE)
    told = judged.groupBy("row_key").agg(
        F.collect_list(F.when(added & few, F.struct("start", "kind", "end"))).alias("added"),
        F.sum((few & F.col("live")).cast("long")).alias("n_live"), F.sum((~few).cast("long")).alias("n_copied"))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    out = found.join(told, "row_key", "left").select("doc_id", base.alias("base"), "added", "n_live", "n_copied")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:long,kind:int,end:long>>"))))
    return out.select("doc_id", "base", spans.alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def listed(spans: str) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _sql_live(v: str) -> str:
    return (f"regexp_matches({v}, '[0-9]') AND regexp_matches({v}, '[A-Za-z]') AND len(list_distinct(string_split({v}, ''))) >= {LEAST_LETTERS}"
            f" AND NOT regexp_matches({v}, '{PLACEHOLDER}')")


def oracle() -> str:
    """The same result as DuckDB SQL over ``documents``."""
    def quoted(p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    each = []
    for i, (_, p, g) in enumerate(BASE + MORE):
        each.append(f"""SELECT r, owner, repo, {i} kind, unnest(m) m, unnest(list_slice(string_split_regex(text, {quoted(p)}), 1, len(m))) p,
  unnest(generate_series(1, len(m))) k, {quoted(p)} re, {g} g FROM (SELECT *, regexp_extract_all(text, {quoted(p)}) m FROM d) WHERE len(m) > 0""")
    value = " ".join(f"WHEN {i} THEN regexp_extract(m, {quoted(p)}, {g})" for i, (_, p, g) in enumerate(BASE + MORE) if g)
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS))
    counts = ", ".join(f"count(*) FILTER (kind = {i}) n_{k}" for i, (k, _, _) in enumerate(BASE))
    n = len(BASE)
    touch = "o.r = c.r AND o.s < c.e AND c.s < o.e"
    kept, parts = "", [f"g{n - 1} AS MATERIALIZED (SELECT * FROM c WHERE kind < {n} AND (kind > 0 OR length(v) >= {SHORTEST}))"]
    for i in range(n, n + len(MORE)):
        parts.append(f"""g{i} AS MATERIALIZED (SELECT * FROM g{i - 1} UNION ALL SELECT * FROM c WHERE kind = {i} AND {_sql_live('v')}
  AND NOT EXISTS (SELECT 1 FROM g{i - 1} o WHERE {touch}))""")
    kept = ",\n".join(parts)
    last = f"g{n + len(MORE) - 1}"
    text = f"CASE kind {names} END || ':' || s || ':' || e"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () r, doc_id, source AS owner, doc_id AS repo, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(each)}),
w AS (SELECT *, (sum(length(p) + length(m)) OVER (PARTITION BY r, kind ORDER BY k))::BIGINT e FROM f),
c AS MATERIALIZED (SELECT r, owner, repo, kind, e - length(m) s, e, CASE kind {value} ELSE m END v FROM w),
{kept},
h AS (SELECT *, count(DISTINCT coalesce(owner, '')) OVER (PARTITION BY v) owners FROM {last}),
t AS (SELECT r, {counts}, coalesce(string_agg({text}, ',' ORDER BY s, kind) FILTER (kind < {n}), '') base,
  coalesce(string_agg({text}, ',' ORDER BY s, kind) FILTER (kind < {n} OR owners <= {MOST_OWNERS}), '') spans,
  count(*) FILTER (kind >= {n} AND owners <= {MOST_OWNERS}) n_added,
  count(*) FILTER (owners <= {MOST_OWNERS} AND {_sql_live('v')}) n_live, count(*) FILTER (owners > {MOST_OWNERS}) n_copied FROM h GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT n_{k}" for k, _, _ in BASE)}, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans,
  coalesce(n_added, 0)::BIGINT n_added, coalesce(n_live, 0)::BIGINT n_live, coalesce(n_copied, 0)::BIGINT n_copied FROM d LEFT JOIN t USING (r)"""


def op13_secret_ownership(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    d = secrets(documents(spark, sf_dir))
    kinds = F.transform("base", lambda s: s["kind"])
    n = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, (k, _, _) in enumerate(BASE)]
    return d.select("doc_id", *n, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"),
                    (F.size("spans") - F.size("base")).cast("long").alias("n_added"), "n_live", "n_copied")
