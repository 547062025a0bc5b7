"""Personal data: patterns propose spans, checksums confirm them, context words move their score.

Every kind is searched over the whole text, leftmost first and without overlap within the kind. Positions are code
points, ends exclusive. A null text counts as empty; each row of a repeated document gets its own result.

The patterns start a search only at the end of the last match or where the character before could not belong to the
same run, and they never give back what a run took: both leave the matches as they are and keep the search linear in
the length of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.storage import fresh

LOCAL = "[A-Za-z0-9._%+-]"
#: kind: pattern, cheap test that a text may hold one, score, words nearby that raise the score.
KINDS = {
    "email": (rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "mail|contact|kontakt|correo|courriel"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, r"\bip\b|server|host|address|adress"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9][0-9 -]{10}", 0.7, "card|karte|tarjeta|carte|visa|credit|payment"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"[+][0-9]", 0.6, "phone|tel|call|mobile|handy|llama|appel"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 0.8, "iban|bank|konto|cuenta|compte|account"),
}
BASE = ("email", "ip", "card", "phone")
#: Code points before a span that are searched for context words, and what such a word adds to the score.
CONTEXT, CONTEXT_GAIN = 40, 0.15
#: Spans whose positions are summed up together; keeps very many spans in one text from costing their square.
_CHUNK = 256


def _digits(hit: str) -> str:
    return f"regexp_replace({hit}, '[^0-9]', '')"


def _luhn(hit: str) -> str:
    """The n-th digit from the right counts double if n is even; 9 is taken from what exceeds 9."""
    d = f"reverse({_digits(hit)})"
    value = f"cast(substring({d}, i + 1, 1) as int)"
    twice = f"({value} * 2 - if({value} > 4, 9, 0))"
    return f"aggregate(transform(sequence(0, length({d}) - 1), i -> if(i % 2 = 0, {value}, {twice})), 0, (a, x) -> a + x) % 10 = 0"


def _mod97(hit: str) -> str:
    """The first four characters go last, letters count 10 to 35, and the number leaves 1 when divided by 97."""
    plain = f"replace({hit}, ' ', '')"
    moved = f"concat(substring({plain}, 5), substring({plain}, 1, 4))"
    c = f"substring({moved}, i, 1)"
    step = f"if({c} between '0' and '9', (a * 10 + cast({c} as int)) % 97, (a * 100 + ascii({c}) - 55) % 97)"
    return f"aggregate(sequence(1, length({moved})), 0, (a, i) -> cast({step} as int)) = 1"


def _valid(kind: str, hit: str) -> str:
    digits = f"length({_digits(hit)})"
    return {
        "email": "true",
        "ip": f"forall(split({hit}, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(ltrim('0', p), 3)) as int) <= 255)",
        "card": f"{digits} between 12 and 19 and {_luhn(hit)}",
        "phone": f"{digits} between 9 and 15",
        "iban": f"length(replace({hit}, ' ', '')) between 15 and 34 and {_mod97(hit)}",
    }[kind]


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _found(text: str, kind: str) -> Column:
    """Array of (start, rank, end, kind, score) of the confirmed spans of one kind."""
    pattern, test, score, words = KINDS[kind]
    p = _quoted(pattern)
    rank = list(KINDS).index(kind)
    nothing = "cast(array() as array<struct<start:int,hit:string>>)"
    pairs = f"zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (gap, hit) -> struct(gap, hit))"
    # split gives one gap more than there are matches: its pair has no hit
    chunk = (
        f"aggregate(slice(pairs, k * {_CHUNK} + 1, {_CHUNK}), struct(0 as at, {nothing} as spans), "
        "(a, p) -> struct(a.at + length(p.gap) + coalesce(length(p.hit), 0) as at, "
        "if(p.hit is null, a.spans, concat(a.spans, array(struct(a.at + length(p.gap) as start, p.hit as hit)))) as spans))"
    )
    chunks = f"transform(sequence(0, (size(pairs) - 1) div {_CHUNK}), k -> {chunk})"
    placed = (
        f"aggregate({chunks}, struct(0 as at, {nothing} as spans), (a, c) -> struct(a.at + c.at as at, "
        "concat(a.spans, transform(c.spans, s -> struct(s.start + a.at as start, s.hit as hit))) as spans)).spans"
    )
    # a lambda over a one-element array names the pairs, so that they are computed once
    located = f"flatten(transform(array({pairs}), pairs -> {placed}))"
    near = f"lower(substring({text}, greatest(s.start - {CONTEXT}, 0) + 1, s.start - greatest(s.start - {CONTEXT}, 0))) rlike {_quoted(words)}"
    spans = (
        f"transform(filter({located}, s -> {_valid(kind, 's.hit')}), s -> named_struct('start', s.start, 'rank', {rank}, "
        f"'end', s.start + length(s.hit), 'kind', '{kind}', 'score', cast({score} as double) + if({near}, {CONTEXT_GAIN}D, 0D)))"
    )
    none = "cast(array() as array<struct<start:int,rank:int,end:int,kind:string,score:double>>)"
    return F.expr(f"if({text} rlike {_quoted(test)}, {spans}, {none})")


def personal_spans(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Add the array of all confirmed spans, by start and then kind."""
    whole = fresh(docs, "__text")
    with_text = docs.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    return with_text.withColumn(out, F.array_sort(F.concat(*(_found(f"`{whole}`", kind) for kind in KINDS)))).drop(whole)


def listed(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kept = spans if kinds is None else f"filter({spans}, s -> s.kind in ({', '.join(repr(k) for k in kinds)}))"
    return F.expr(f"array_join(transform({kept}, s -> concat_ws(':', s.kind, cast(s.start as string), cast(s.end as string))), ',')")


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of each row of ``documents`` (doc_id, text)."""
    found = personal_spans(docs.select("doc_id", "text"), out="pii").drop("text")
    counts = [F.expr(f"cast(size(filter(pii, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in KINDS]
    scores = F.expr("array_join(transform(pii, s -> format_number(s.score, 2)), ',')").alias("scores")
    return found.select("doc_id", *counts[:4], F.sha2(listed("pii", BASE).cast("binary"), 256).alias("base_sha256"), listed("pii").alias("spans"), counts[4], scores)


def redacted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The same table with every span of at least this score replaced by its kind in angle brackets.

    Overlapping spans become one, named by the first. A null text stays null.
    """
    spans = fresh(docs, "__pii")
    step = (
        "(a, s) -> if(s.start < a.at, struct(a.done as done, greatest(a.at, s.end) as at), "
        "struct(concat(a.done, substring(`text`, a.at + 1, s.start - a.at), '<', upper(s.kind), '>') as done, s.end as at))"
    )
    kept = f"filter(`{spans}`, s -> s.score >= {least})"
    masked = f"aggregate({kept}, struct('' as done, 0 as at), {step}, a -> concat(a.done, substring(`text`, a.at + 1)))"
    found = personal_spans(docs, out=spans)
    return found.withColumn("text", F.expr(f"if(`text` is null or size({kept}) = 0, `text`, {masked})")).select(*docs.columns)
