"""Personal data: fixed formats, and what contexts learned from them find besides.

Matches of four formats are the seeds. Every identifier-like token, and every few neighbouring groups of
digits, is a possible instance; the words around it are its lexical patterns, and its shape is one more. Spark scores the graph of patterns and instances in rounds: a
pattern counts for a kind by the share and number of known instances of the kind among all that it
holds, and an instance by the patterns that hold it. Accepted instances count as known in the next
round, and at the end their spans are added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from repopulse.llm import textops as T
from repopulse.llm.store import IdFilter, stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: A pattern counts for a kind from this share and number of known instances.
PATTERN_SHARE = 0.8
PATTERN_KNOWN = 4
#: An instance is accepted from this confidence, and this number of patterns.
INSTANCE_CONFIDENCE = 0.9
INSTANCE_PATTERNS = 2
#: Code points looked at on either side of an instance for its patterns' words.
CONTEXT = 64

# The formats.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match from within a run of digits would end like one from its start, so only starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Signs that may stand around a token, and the least a token needs to be looked at.
_AROUND = "\"'()[]{}<>,;:.!?|#*$%&="
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_LEAST_LENGTH, _LEAST_DIGITS, _MOST_LENGTH = 6, 4, 256
#: Neighbouring groups of digits, which may be one number, and the most digits of one.
_GROUPS = re.compile(r"(?<![\w().+/-])[(+]{0,2}[0-9][0-9()./-]*+(?:[ \u00a0][(]?[0-9][0-9()./-]*+)++")
_MOST_DIGITS = 19

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """Each match holds one `@`, so it is found from there."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            yield "ip", m.start(), m.end()


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[::-2])) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield "phone", m.start(), m.end()


def base_spans(text: str) -> list[Span]:
    """All matches of the four formats, by kind and then by place."""
    return [*emails(text), *ips(text), *cards(text), *phones(text)]


def shape(value: str) -> str:
    """A token's signs with its runs of digits and of letters each as one."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", value))


def _words(text: str) -> list[str]:
    """The words of a context; signs that stand alone, such as those between columns, are none."""
    bare = (w.strip(_AROUND).lower() for w in text.split())
    return [re.sub(r"[0-9]+", "0", w) for w in bare if w]


def patterns(text: str, start: int, end: int) -> list[str]:
    """The words around a span: two before it, one on either side, two after it. Words may be cut
    by the reach of the context, so the outermost of a full context is left out."""
    before = text[max(0, start - CONTEXT) : start]
    after = text[end : end + CONTEXT]
    left, right = _words(before), _words(after)
    if start > CONTEXT:
        left = left[1:]
    if end + CONTEXT < len(text):
        right = right[:-1]
    found = []
    if len(left) > 1:
        found.append("l " + " ".join(left[-2:]))
    if left and right:
        found.append("m " + left[-1] + " " + right[0])
    if len(right) > 1:
        found.append("r " + " ".join(right[:2]))
    return found


def _single(text: str) -> Iterator[tuple[int, int]]:
    """Tokens with an `@` or a few digits."""
    for m in _TOKEN.finditer(text):
        core = m[0].strip(_AROUND)
        digits = sum("0" <= c <= "9" for c in core)
        if _LEAST_LENGTH <= len(core) <= _MOST_LENGTH and (digits >= _LEAST_DIGITS or "@" in core):
            start = m.start() + m[0].index(core)
            yield start, start + len(core)


def _grouped(text: str) -> Iterator[tuple[int, int]]:
    """Two or more neighbouring groups of digits that may be one number."""
    for m in _GROUPS.finditer(text):
        core = m[0].rstrip("(./-")
        if m.end() < len(text) and (text[m.end()].isalnum() or text[m.end()] in "_@"):
            # The last group goes on as a word.
            core = re.sub(r"[ \u00a0][^ \u00a0]*$", "", m[0]).rstrip("(./-")
            if not re.search("[ \u00a0]", core):
                continue
        if "(" not in core:
            core = core.rstrip(")")
        digits = sum("0" <= c <= "9" for c in core)
        if _LEAST_LENGTH <= len(core) <= _MOST_LENGTH and _LEAST_DIGITS <= digits <= _MOST_DIGITS:
            yield m.start(), m.start() + len(core)


def tokens(text: str, taken: list[Span]) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens, and neighbouring groups of digits, that no base span touches."""
    edges = sorted((start, end) for _, start, end in taken)
    for found in (_single(text), _grouped(text)):
        at = 0
        for start, end in found:
            while at < len(edges) and edges[at][1] <= start:
                at += 1
            if not any(a < end and start < b for a, b in edges[max(0, at - 1) : at + 4]):
                yield start, end


def _number(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_SPAN = "struct<kind:string,start:long,stop:long>"
_CANDIDATE = "struct<kind:string,start:long,stop:long,value:long,patterns:array<long>>"


def _scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base spans, and all candidates (base ones with their kind)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            base, found = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                spans = base_spans(text)
                base.append([{"kind": k, "start": s, "stop": e} for k, s, e in spans])
                rows = [*spans, *[(None, s, e) for s, e in tokens(text, spans)]]
                found.append(
                    [
                        {
                            "kind": k,
                            "start": s,
                            "stop": e,
                            "value": _number(text[s:e]),
                            "patterns": [_number(p) for p in (*patterns(text, s, e), f"s {shape(text[s:e])}")],
                        }
                        for k, s, e in rows
                    ]
                )
            span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
            more = [("value", pa.int64()), ("patterns", pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(base, pa.list_(span)),
                    pa.array(found, pa.list_(pa.struct([*span, *[pa.field(*f) for f in more]]))),
                ],
                names=["doc_id", "base", "found"],
            )

    return docs.mapInArrow(run, f"doc_id long, base array<{_SPAN}>, found array<{_CANDIDATE}>")


def _learn(candidates: DataFrame, rounds: int) -> DataFrame:
    """(value, kind) of the instances that the rounds accept.

    A value's shape is a pattern like its contexts, so one context and the shape can accept it, or two
    contexts whatever its shape. A pattern or value with very many occurrences is one row per task in each count. A value of two
    base kinds has the first of them.
    """
    edges = stored(candidates.selectExpr("explode(patterns) as pattern", "value").distinct(), "edges")
    held = stored(edges.groupBy("pattern").agg(F.count("*").alias("held")).where(f"held >= {PATTERN_KNOWN}"), "held")
    edges = stored(edges.join(held.select("pattern"), "pattern"), "edges")
    values = candidates.groupBy("value").agg(F.min("kind").alias("kind"))
    values = stored(values, "values")
    known = values.where("kind is not null").select("value", "kind")
    for _ in range(rounds):
        counted = edges.join(known, "value").groupBy("pattern", "kind").agg(F.count("*").alias("known"))
        good = counted.join(held, "pattern").selectExpr("pattern", "kind", "known", "known / held as share")
        # Stored before it is joined, so that the rows of a hot shape can be split.
        good = stored(good.where(f"known >= {PATTERN_KNOWN} and share >= {PATTERN_SHARE}"), "good")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("share"), F.lit(0.01)))))
        new = (
            edges.join(good, "pattern")
            .groupBy("value", "kind")
            .agg((1 - doubt).alias("confidence"), F.count("*").alias("patterns"))
            .where(f"confidence >= {INSTANCE_CONFIDENCE} and patterns >= {INSTANCE_PATTERNS}")
            .join(values.where("kind is null").select("value"), "value")
            .groupBy("value")
            .agg(F.max(F.struct("confidence", "kind")).alias("best"))
            .select("value", "best.kind")
        )
        base = values.where("kind is not null").select("value", "kind")
        known = stored(base.unionByName(new), "known")
    return stored(known.join(values.where("kind is null").select("value"), "value"), "discovered")


def _find(docs: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Per row its base spans, and (row, kind, start, stop) of the spans that learning adds."""
    T.prepare(docs)
    rows = _scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "scanned")
    candidates = rows.select("row", F.explode("found").alias("c")).select("row", "c.*")
    learned = _learn(candidates, rounds)
    added = candidates.where("kind is null").drop("kind").join(learned, "value").select("row", "kind", "start", "stop")
    return rows.select("row", "doc_id", "base"), added


def _text(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Places are code points, ends exclusive. The counts and the digest are of the base spans, by kind
    and then start; `spans` holds these and the added ones in the same order. A null text is an empty
    one, without spans; repeated rows and null ids are rows like others; other columns are ignored.
    """
    rows, added = _find(docs, rounds)
    order = " ".join(f"when '{kind}' then {n}" for n, kind in enumerate(KINDS))
    ordered = added.select(
        "row", F.struct(F.expr(f"case kind {order} end").alias("n"), "start", "stop", "kind").alias("span")
    )
    # The spans of one document, so of bounded number.
    per_row = ordered.groupBy("row").agg(F.collect_list("span").alias("every"))
    # A token within a longer added span is part of it.
    wider = "o.start <= s.start and o.stop >= s.stop and o.stop - o.start > s.stop - s.start"
    per_row = per_row.selectExpr("row", f"filter(every, s -> not exists(every, o -> {wider})) as more")
    joined = rows.join(per_row, "row", "left")
    base = f"transform(base, s -> struct(case s.kind {order} end as n, s.start as start, s.stop as stop, s.kind as kind))"
    every = f"array_sort(concat({base}, coalesce(more, array())))"
    counts = [f"cast(size(filter(base, s -> s.kind = '{kind}')) as long) as n_{kind}" for kind in KINDS]
    return joined.selectExpr(
        "doc_id",
        *counts,
        f"sha2({_text('base')}, 256) as base_sha256",
        f"{_text(every)} as spans",
        "cast(coalesce(size(more), 0) as long) as n_added",
    )


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, or each group of overlapping ones, as `<KIND>` of its first."""
    out, at = [], 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def without_personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """`docs` with every span in `text` replaced by its kind, and `n_chars`, where there is one, the
    new length. All rows and columns stay. Rows that share an id get the added spans of all of them
    that they hold themselves; a null text stays null.

    Base spans are found again where the document is read, so only documents with added spans, which
    are few, are joined with them. No task has two Python workers at once: an executor would keep both.
    """
    # The text goes to Python once, beside the other columns.
    others = F.struct(*[T.column(c) for c in docs.columns if c != "text"]).alias("_row")
    docs_rows = docs.select(others, F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    rows, added = _find(docs, rounds)
    spans = added.join(rows.select("row", "doc_id"), "row").where("doc_id is not null")
    spans = stored(spans.select("doc_id", "kind", "start", "stop").distinct(), "added")
    held = IdFilter(spans.select("doc_id"))
    per_doc = spans.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("kind", "start", "stop")).alias("_more"))
    plain = docs_rows.select("_row", "_id", "_text", F.lit(None).cast(f"array<{_SPAN}>").alias("_more"))
    marked = docs_rows.where(held.column(F.col("_id")))
    # With an exchange at any size, so that its Python is not in the task of what comes after.
    joined = marked.join(per_doc.hint("merge"), F.col("_id") == F.col("_doc"), "left").select("_row", "_text", "_more")

    def run(batches: Iterator[pa.RecordBatch], left_out: IdFilter | None = None) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            if left_out is not None:
                batch = batch.filter(pa.array(~left_out.among(batch.column("_id"))))
            texts = []
            for text, more in zip(batch.column("_text"), batch.column("_more")):
                text = text.as_py()
                if text:
                    spans = base_spans(text)
                    own = set(tokens(text, spans))
                    learned = [(s["kind"], s["start"], s["stop"]) for s in more.as_py() or []]
                    text = redact(text, spans + [s for s in learned if s[1:] in own])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())], names=["_row", "_text"])

    fields = [docs_rows.schema["_row"], StructField("_text", StringType())]
    clean = plain.mapInArrow(lambda batches: run(batches, held), StructType(fields))
    clean = clean.unionByName(joined.mapInArrow(run, StructType(fields)))
    columns = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    lengths = {f.name for f in docs.schema if f.name == "n_chars" and isinstance(f.dataType, LongType)}
    return clean.select(
        *[
            (columns[c] if c == "text" or c in lengths else F.col("_row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )
