"""Personal data: fixed patterns, widened by bootstrapped contextual extraction.

The fixed patterns (email, ip, card, phone) give base spans, which always stay.
Their strings are the seed entities.  Every other token with a digit or an at
sign is a possible instance, and so is every run of digits with blanks, brackets,
points or hyphens between base spans.  Instances and the words around them form a graph:
a lexical pattern is one or two words on the left, a word on the right, or both
sides.  Spark scores the graph in rounds.  A pattern's confidence for a kind is
the share of its instance weight that is reliably of this kind: other
identifiers count against it, those whose form allows the kind by half, and it needs ``support`` different reliable
instances; an instance's reliability is one minus the product of the doubts of
the accepted patterns around it, and only for kinds that its form allows.  Seeds
have reliability 1 wherever they occur, so an occurrence that the fixed patterns
could not delimit is found as well.  Instances of at least ``accept`` give spans.

The graph has one edge per pattern and instance, summed on the map side, so a
frequent pattern costs its distinct instances; its joins have one row for a key
on the scored side, and Spark splits a hot key on the other.

Defined results: null or empty texts have no spans.  A repeated row gives the
same spans again; rows sharing a doc_id are told apart by a hash of their text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triad.llm.common import columns, cut, slices

#: The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
POSSIBLE = re.compile(r"[^\s0-9@]*[0-9@]\S*")
RUN = re.compile(r"(?<!\w)[+(]?(?<!\w)[0-9][\x20().0-9-]*[0-9](?![\w@])")
EDGE = "!\"#$%&'()*+,-./:;<=>?[\\]^_`{|}~"


@dataclass(frozen=True)
class Bootstrap:
    rounds: int = 3
    support: int = 5             # different reliable instances of a pattern
    confidence: float = 0.9      # of a pattern
    accept: float = 0.95         # reliability of an instance that gives spans
    reach: int = 120             # characters first looked at for words on either side; more if a word is longer


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def small(number: str) -> bool:
    """Whether a number is at most 255; it may have any length."""
    bare = number.lstrip("0")
    return len(bare) < 3 or len(bare) == 3 and int(bare) <= 255


def digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of LOCAL@DOMAIN, found from each at sign so that no run is read twice."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) in code points, by start and then kind."""
    out = [(s, e, 0) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(*m.span(), 1) for m in IP.finditer(text) if all(small(x) for x in m[0].split("."))]
        for m in CARD.finditer(text):
            d = digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), 2))
        if "+" in text:
            out += [(*m.span(), 3) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=by_start_and_kind)


def by_start_and_kind(span: tuple[int, int, int]) -> tuple[int, int, int]:
    start, end, kind = span
    return start, kind, end


def forms(token: str) -> list[int]:
    """The kinds whose form a token or run outside the fixed patterns may have."""
    n = len(digits(token))
    out = []
    if re.fullmatch(r"[^@\s]+@[^@\s]+", token):
        out.append(0)
    if re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", token) or re.fullmatch(r"[0-9A-Fa-f]{0,4}(:[0-9A-Fa-f]{0,4}){3,7}", token):
        out.append(1)
    if 12 <= n <= 19 and re.fullmatch(r"[\x200-9-]+", token):
        out.append(2)
    if 7 <= n <= 15 and re.fullmatch(r"[\x200-9().+-]+", token):
        out.append(3)
    return out


def words_before(text: str, start: int, reach: int) -> list[str]:
    """The last two words before ``start``, whole however long."""
    while True:
        words = text[max(0, start - reach):start].split()
        if reach >= start or len(words) > 2:
            return words[-2:]
        reach *= 2


def word_after(text: str, end: int, reach: int) -> list[str]:
    while True:
        words = text[end:end + reach].split()
        if end + reach >= len(text) or len(words) > 1:
            return words[:1]
        reach *= 2


def around(text: str, start: int, end: int, reach: int) -> list[str]:
    """The lexical patterns of a span: words in lower case without outer marks."""
    left = [w.strip(EDGE).lower() or w for w in words_before(text, start, reach)]
    right = [w.strip(EDGE).lower() or w for w in word_after(text, end, reach)]
    left = ["#" if DIGIT.search(w) else w for w in left]
    right = ["#" if DIGIT.search(w) else w for w in right]
    out = [f"L {left[-1]}"] if left else ["L ^"]
    out += [f"LL {left[-2]} {left[-1]}"] if len(left) > 1 else []
    out += [f"R {right[0]}"] if right else ["R $"]
    out += [f"LR {left[-1]} {right[0]}"] if left and right else []
    return out


def runs(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of digits with blanks inside, between the base spans."""
    at = 0
    for start, end in [*((s, e) for s, e, _ in spans), (len(text), len(text))]:
        for m in RUN.finditer(text, at, max(at, start)):
            if " " in m[0]:
                yield m.span()
        at = max(at, end)


def occurrences(text: str, spans: list[tuple[int, int, int]], reach: int) -> list[tuple]:
    """(start, end, kind or None, instance, forms, patterns) of base spans and other possible instances."""
    out = [(s, e, k, text[s:e], [k], around(text, s, e, reach)) for s, e, k in spans]
    if spans or DIGIT.search(text) or "@" in text:
        taken = np.array([(s, e) for s, e, _ in spans], dtype=np.int64).reshape(-1, 2)
        for m in POSSIBLE.finditer(text):
            token = m[0].strip(EDGE)
            start = m.start() + m[0].index(token) if token else 0
            allowed = forms(token) if len(token) > 4 else []
            end = start + len(token)
            if allowed and not ((taken[:, 0] < end) & (taken[:, 1] > start)).any():
                out.append((start, end, None, token, allowed, around(text, start, end, reach)))
        for start, end in runs(text, spans):
            allowed = forms(text[start:end])
            if allowed:
                out.append((start, end, None, text[start:end], allowed, around(text, start, end, reach)))
    return out


SPAN = "array<struct<start: long, end: long, kind: int>>"
SEEN = ("array<struct<start: long, end: long, kind: int, instance: string, forms: array<int>, "
        "patterns: array<string>>>")


def scan(docs: DataFrame, p: Bootstrap) -> DataFrame:
    """doc_id, text_hash, base spans and occurrences of every row."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))
    seen = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("instance", pa.string()),
                               ("forms", pa.list_(pa.int32())), ("patterns", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            spans, found = [], []
            for text in b.column("text").to_pylist():
                base = base_spans(text) if text else []
                spans.append([dict(zip(("start", "end", "kind"), s, strict=True)) for s in base])
                found.append([dict(zip(("start", "end", "kind", "instance", "forms", "patterns"), o, strict=True))
                              for o in (occurrences(text, base, p.reach) if text else [])])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(spans, span), pa.array(found, seen)],
                                             names=["doc_id", "text_hash", "spans", "seen"])

    src = columns(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return src.mapInArrow(run, f"doc_id long, text_hash long, spans {SPAN}, seen {SEEN}")


def reliabilities(occ: DataFrame, p: Bootstrap) -> DataFrame:
    """instance, kind, r: the scored instances, seeds included."""
    edges = cut(occ.select(F.explode("patterns").alias("pattern"), "instance").groupBy("pattern", "instance").agg(
        F.log1p(F.count(F.lit(1))).alias("w")))
    seeds = occ.where(F.col("kind").isNotNull()).select("instance", "kind").distinct().withColumn("r", F.lit(1.0))
    allowed = occ.where(F.col("kind").isNull()).select("instance", F.explode("forms").alias("kind")).distinct()
    weight = edges.groupBy("pattern").agg(F.sum("w").alias("all"))
    known = scored = cut(seeds)
    for _ in range(p.rounds):
        by = edges.join(scored, "instance").groupBy("pattern", "kind").agg(
            F.sum(F.col("w") * F.col("r")).alias("good"),
            F.sum(F.when(F.col("r") >= p.accept, 1).otherwise(0)).alias("support")).where(F.col("support") >= p.support)
        undecided = allowed.join(scored.where(F.col("r") >= p.accept), ["instance", "kind"], "left_anti")
        undecided = edges.join(undecided, "instance").groupBy("pattern", "kind").agg(F.sum("w").alias("open"))
        conf = F.col("good") / (F.col("all") - F.coalesce("open", F.lit(0.0)) / 2)
        trusted = by.join(weight, "pattern").join(undecided, ["pattern", "kind"], "left").withColumn("conf", F.least(F.lit(1.0), conf))
        trusted = trusted.where(F.col("conf") >= p.confidence)
        doubt = F.sum(F.log1p(-F.least("conf", F.lit(0.999))))
        more = edges.join(trusted.select("pattern", "kind", "conf"), "pattern").groupBy("instance", "kind").agg(
            (F.lit(1.0) - F.exp(doubt)).alias("r"))
        more = more.join(allowed, ["instance", "kind"], "left_semi").join(known, ["instance", "kind"], "left_anti")
        scored = cut(known.unionByName(more))
    return scored


def added_spans(rows: DataFrame, p: Bootstrap) -> DataFrame:
    """doc_id, text_hash, added: the spans beyond the base of the rows that have some."""
    occ = rows.select("doc_id", "text_hash", F.explode("seen").alias("o")).select("doc_id", "text_hash", "o.*")
    occ = cut(occ)
    best = Window.partitionBy("instance").orderBy(F.desc("r"), "kind")
    kinds = reliabilities(occ, p).where(F.col("r") >= p.accept).withColumn("n", F.row_number().over(best))
    kinds = kinds.where("n = 1").select("instance", F.col("kind").alias("as"))
    new = occ.where(F.col("kind").isNull()).join(kinds, "instance").where(F.array_contains("forms", F.col("as")))
    return new.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "end", F.col("as").alias("kind"))).alias("added"))


def same_row(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & a["text_hash"].eqNullSafe(b["text_hash"])


def personal_data(docs: DataFrame, p: Bootstrap = Bootstrap()) -> DataFrame:
    """doc_id, ``base`` and ``spans`` (sorted, code points) of every row."""
    rows = cut(scan(docs, p))
    new = added_spans(rows, p)
    base = rows.select("doc_id", "text_hash", "spans")
    every = F.concat("spans", F.coalesce("added", F.array().cast(SPAN)))
    by_kind = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return base.join(new, same_row(base, new), "left").select(
        base["doc_id"], F.col("spans").alias("base"), by_kind.alias("_spans")).select(
        "doc_id", "base", F.transform("_spans", lambda s: F.struct(s["start"], s["end"], s["kind"])).alias("spans"))


def joined(spans: str):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_bootstrapped_pii(spark, sf_dir: str) -> DataFrame:
    """Base counts and digest, and all spans, of every document."""
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def n(k: int):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    return found.select("doc_id", *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
                        (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span, or run of overlapping spans, becomes the name of its first kind."""
    out, at = [], 0
    for i, (start, end, kind) in enumerate(spans):
        if start >= at or not i:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, p: Bootstrap = Bootstrap()) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` renewed."""
    new = added_spans(cut(scan(docs, p)), p).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("added").alias("_added"))
    names = docs.columns
    rows = docs.join(new, docs["doc_id"].cast("long").eqNullSafe(new["_id"]) & F.xxhash64(docs["text"].cast("string")).eqNullSafe(new["_hash"]), "left")
    texts = rows.select(*[docs[c] for c in names], "_added")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out = []
            for text, more in zip(b.column("text").to_pylist(), b.column("_added").to_pylist(), strict=True):
                spans = base_spans(text) if text else []
                spans = sorted(spans + [(s["start"], s["end"], s["kind"]) for s in more or []], key=by_start_and_kind)
                out.append(mask(text, spans) if spans else text)
            cols = {c: b.column(c) for c in names} | {"text": pa.array(out, pa.string())}
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([None if t is None else len(t) for t in out], pa.int64())
            yield pa.RecordBatch.from_pydict(cols)

    fields = [f"`{c}` {'string' if c == 'text' else 'long' if c == 'n_chars' else t}" for c, t in docs.dtypes]
    return texts.mapInArrow(run, ", ".join(fields))
