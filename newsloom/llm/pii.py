"""Personal data by weak supervision, in DataFrame functions only.

Strict patterns give the base spans.  Looser patterns propose candidates; regex, checksum, gazetteer and context labelers
vote on base spans and candidates alike.  Expectation-maximisation over the counts of vote patterns estimates how reliable
each labeler is for each kind, and its soft labels train a logistic span classifier, which decides which candidates
join the base spans.  Base spans always stay.

What reaches the driver is one count for each pattern of kind, votes and shape, at most ``PATTERNS`` rows whatever the
size of the input; every row of the input is counted.

Positions are found without Python: the pieces between matches and the matches alternate, so their running lengths are the
offsets.  Running values are taken by doubling steps and spans are compared in order, so the work on a text with n spans
grows with n log n.  The patterns are written so that no text makes them scan a run twice: a run of an address's characters is
entered only at its start or where the last match ended, and repetitions are possessive wherever nothing follows them.

Defined results: a null text is empty and stays null when masked; repeated rows give a row each; other columns are not
looked at, and kept as they are by mask().  With no candidates at all, nothing is learnt and only base spans come out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .common import Scratch

#: Kinds in the order of listing; the last two come from candidates only.
KINDS = ("email", "ip", "card", "phone", "ssn", "address")
_LOCAL = r"[A-Za-z0-9._%+-]"
_ENTER = rf"(?:\G|(?<!{_LOCAL}))"

#: Strict patterns.
STRICT = {
    "email": rf"{_ENTER}{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a strict pattern to give a span that passes, where that is less than the pattern itself.
GATES = {"email": "@", "phone": r"\+[0-9]", "card": r"(?:[0-9][\x20-]?){15}[0-9]"}
#: Kinds of streets (fixed values).
STREETS = "Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln|Drive|Dr|Court|Ct|Square|Sq|Terrace|Highway|Parkway"
#: Loose patterns: written-out mail addresses, national numbers, short card numbers, social-security shapes, streets with a number.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "address": rf"(?<![0-9.,-])[0-9]{{1,5}}(?:\x20[A-Z][a-z]{{1,20}}){{1,3}}\x20(?:{STREETS})\b",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

#: Gazetteers and cue words (fixed values).
TOP_LEVEL = "com org net edu gov io info biz de fr es it uk eu us ca au jp cn in br nl ch at be se no fi dk pl ru"
CUES = {
    "email": "mail|e-mail|email|contact|write|reach|adresse|correo|courriel",
    "ip": "ip|host|server|address|router|adresse|servidor",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|pan",
    "phone": "phone|tel|call|fax|mobile|cell|whatsapp|telefon|telephone|movil",
    "ssn": "ssn|social security|social-security|tax id|sozialversicherung",
    "address": "address|live|lives|living|resident|residence|home|located|ship|deliver|mailing|adresse",
}
COUNTER_CUES = "version|isbn|issn|order|invoice|part|page|ref|serial|build|section|figure|table"
#: Code points before a span, back to the last match of its pattern, in which a cue counts.
CONTEXT = 40

#: The regex or checksum labeler, the gazetteer, and two context labelers.
VOTES = ("checked", "listed", "cued", "countered")
#: kinds x strict or not x votes x length classes x separators
PATTERNS = len(KINDS) * 2 * 2 ** len(VOTES) * 4 * 2
_SPAN = "array<struct<start:bigint,end:bigint,kind:string,value:string,before:string,strict:boolean>>"


def _found(text: Column, pattern: str, kind: str, strict: bool) -> Column:
    """Matches with their offsets and what stands before them; a text that can't have any is only looked at once."""
    made = F.transform(t.matches(text, pattern, CONTEXT), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"), x["before"].alias("before"), F.lit(strict).alias("strict")))
    return F.when(text.rlike(GATES.get(kind, pattern) if strict else pattern), made.cast(_SPAN)).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass; the caller bounds their number."""
    n = F.length(_digits(value))

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(_digits(value), n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), step) % 10 == 0


def _passes(s: Column) -> Column:
    """The checks that strict matches must pass."""
    n = F.length(_digits(s["value"]))
    return (
        F.when(s["kind"] == "ip", s["value"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
        .when(s["kind"] == "card", F.when((n >= 16) & (n <= 19), _luhn(s["value"])).otherwise(F.lit(False)))
        .when(s["kind"] == "phone", (n >= 8) & (n <= 15))
        .otherwise(F.lit(True))
    )


def _checked(s: Column) -> Column:
    n = F.length(_digits(s["value"]))
    return (
        F.when(s["kind"] == "card", F.when((n >= 13) & (n <= 19), _luhn(s["value"])).otherwise(F.lit(False)))
        .when(s["kind"] == "phone", s["strict"] | s["value"].rlike(r"^\(?[2-9][0-9]{2}\)?[\x20.-][2-9]"))
        .when(s["kind"] == "ssn", ~s["value"].rlike("^(?:000|666|9[0-9]{2})|-00-|-0000$"))
        .when(s["kind"] == "address", ~s["value"].rlike("^0"))
        .otherwise(F.lit(True))
    )


def _listed(s: Column) -> Column:
    ends = "|".join(TOP_LEVEL.split())
    return (
        F.when(s["kind"] == "email", F.lower(s["value"]).rlike(rf"(?:{ends})$"))
        .when(s["kind"] == "card", s["value"].rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6)"))
        .when(s["kind"] == "phone", s["value"].rlike(r"^\+[1-9]|^\([0-9]{3}\)"))
        .when(s["kind"] == "address", s["value"].rlike(r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Drive)$"))
        .when(s["kind"] == "ip", s["value"].rlike(r"^(?:10|127|172|192|[1-9][0-9]{0,2})\."))
        .otherwise(F.lit(False))
    )


def _voted(s: Column) -> Column:
    before = F.lower(s["before"])
    cue = F.lit(False)
    for kind, words in CUES.items():
        cue = F.when(s["kind"] == kind, before.rlike(rf"\b(?:{words})\b")).otherwise(cue)
    size = s["end"] - s["start"]
    return F.struct(
        *(s[k].alias(k) for k in ("kind", "start", "end")),
        s["strict"].cast("int").alias("strict"),
        _checked(s).cast("int").alias("checked"),
        _listed(s).cast("int").alias("listed"),
        cue.cast("int").alias("cued"),
        before.rlike(rf"\b(?:{COUNTER_CUES})\b").cast("int").alias("countered"),
        F.when(size < 12, 0).when(size < 17, 1).when(size < 24, 2).otherwise(3).alias("size"),
        s["value"].rlike(r"[\x20()-]").cast("int").alias("apart"),
    )


def _apart(base: Column, loose: Column) -> Column:
    """Base spans, and the candidates that cross none of them.

    In order of their starts, a candidate crosses a base span before it if the greatest end so far lies behind its start, and
    one after it if the next base start lies before its end.
    """

    def chosen(every: Column) -> Column:
        ends = t.running(F.transform(every, lambda s: F.when(s["strict"], s["end"])), F.greatest)
        starts = t.running(F.reverse(F.transform(every, lambda s: F.when(s["strict"], s["start"]))), F.least)
        place = lambda e, n, s, i: s["strict"] | ~F.coalesce(F.get(e, i) > s["start"], F.lit(False)) & ~F.coalesce(F.get(n, F.size(n) - 1 - i) < s["end"], F.lit(False))
        return t.let(ends, lambda e: t.let(starts, lambda n: F.filter(every, lambda s, i: place(e, n, s, i))))

    both = F.when((F.size(base) > 0) & (F.size(loose) > 0), t.let(F.array_sort(F.concat(base, loose)), chosen))
    return F.coalesce(both, F.concat(base, loose))


def candidates(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds a column of base spans and candidates, each with its votes; candidates that cross a base span are dropped."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(*(_found(text, p, kind, True) for kind, p in STRICT.items()))
    loose = F.concat(*(_found(text, p, kind, False) for kind, p in LOOSE.items()))
    found = t.let(F.filter(base, _passes), lambda b: t.let(loose, lambda c: _apart(b, c)))
    return df.withColumn(out, F.transform(found, _voted))


class Classifier:
    """Weights of the logistic span classifier, a bias for each kind, and what the labelers turned out to be worth."""

    features = (*VOTES, "size", "apart")

    def __init__(self, bias: dict[str, float], weights: dict[str, float], reliability: dict):
        self.bias, self.weights, self.reliability = bias, weights, reliability

    def accepts(self, s: Column) -> Column:
        z = F.lit(0.0)
        for kind, b in self.bias.items():
            z = F.when(s["kind"] == kind, F.lit(b)).otherwise(z)
        for name, w in self.weights.items():
            z = z + s[name] * F.lit(w)
        return (s["strict"] == 1) | (z > 0)


def estimate(rows: list[dict], rounds: int = 30) -> tuple[dict, list[float]]:
    """What the votes of one kind are worth, by expectation-maximisation, and for each pattern the probability of being right.

    rows: a vote of 0 or 1 for each labeler, and n, how often that pattern occurs.  The result has for each labeler how often it
    votes for right spans and for wrong ones, and the share of right spans.
    """
    prior, yes = 0.5, {v: 0.2 if v == "countered" else 0.8 for v in VOTES}
    no, soft = {v: 0.2 for v in VOTES}, [0.5] * len(rows)
    for _ in range(rounds):
        a = b = 1.0
        hit, miss = {v: (1.6, 0.4) if v != "countered" else (0.4, 1.6) for v in VOTES}, {v: (0.4, 1.6) for v in VOTES}
        for i, r in enumerate(rows):
            x, y = math.log(prior), math.log(1 - prior)
            for v in VOTES:
                x += math.log(yes[v] if r[v] else 1 - yes[v])
                y += math.log(no[v] if r[v] else 1 - no[v])
            p = soft[i] = 1 / (1 + math.exp(max(-700, min(700, y - x))))
            a, b = a + p * r["n"], b + (1 - p) * r["n"]
            for v in VOTES:
                h, m = hit[v], miss[v]
                hit[v] = (h[0] + p * r["n"], h[1]) if r[v] else (h[0], h[1] + p * r["n"])
                miss[v] = (m[0] + (1 - p) * r["n"], m[1]) if r[v] else (m[0], m[1] + (1 - p) * r["n"])
        prior = a / (a + b)
        yes, no = ({v: x[0] / sum(x) for v, x in d.items()} for d in (hit, miss))
    return {v: (yes[v], no[v]) for v in VOTES} | {"prior": prior}, soft


def fit(found: DataFrame, out: str, rounds: int = 30) -> Classifier:
    """Counts the patterns, estimates reliabilities by EM, and trains the classifier on the soft labels."""
    names = ["kind", "strict", *VOTES, "size", "apart"]
    counted = found.select(F.explode(out).alias("s")).groupBy(*(F.col(f"s.{k}").alias(k) for k in names)).agg(F.count("*").alias("n"))
    rows = [r.asDict() for r in counted.collect()]  # at most PATTERNS rows
    rows.sort(key=lambda r: [r[k] for k in names])
    reliability, soft = {}, {}
    for kind in KINDS:
        own = [r for r in rows if r["kind"] == kind]
        reliability[kind], right = estimate(own, rounds)
        soft |= {tuple(r[k] for k in names): p for r, p in zip(own, right, strict=True)}
    bias, weights = dict.fromkeys(KINDS, -3.0), {k: 0.0 for k in Classifier.features} | {"checked": 1.0, "listed": 1.0, "cued": 2.5, "countered": -2.0}
    start, start_bias = dict(weights), dict(bias)
    total = sum(math.log1p(r["n"]) for r in rows if not r["strict"]) or 1.0
    for _ in range(200):
        g, gb = dict.fromkeys(weights, 0.0), dict.fromkeys(bias, 0.0)
        for r in rows:
            if r["strict"]:
                continue  # strict spans are accepted anyway; what is learnt is how to tell the candidates apart
            z = bias[r["kind"]] + sum(w * r[k] for k, w in weights.items())
            d = (soft[tuple(r[k] for k in names)] - 1 / (1 + math.exp(-max(-500, min(500, z))))) * math.log1p(r["n"]) / total
            gb[r["kind"]] += d
            for k in g:
                g[k] += d * r[k]
        weights = {k: w + 0.5 * (g[k] - 0.01 * (w - start[k])) for k, w in weights.items()}
        bias = {k: w + 0.5 * (gb[k] - 0.01 * (w - start_bias[k])) for k, w in bias.items()}
    return Classifier(bias, weights, reliability)


def detect(docs: DataFrame, scratch, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id and its spans, array<struct<kind,start,end,base>>, sorted by kind as listed, then start.

    The candidates of all documents are written to the shared scratch folder once, so that texts are searched once.
    """
    df = candidates(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "found").select("id", "found")
    kept = scratch.keep(df, "spans")
    model = fit(kept, "found")
    return kept.select(F.col("id").alias(id_col), _sorted(F.filter("found", model.accepts)).alias("spans"))


def _sorted(spans: Column) -> Column:
    rank = lambda k: F.array_position(F.array(*map(F.lit, KINDS)), k)
    order = F.array_sort(F.transform(spans, lambda s: F.struct(rank(s["kind"]).alias("r"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), (s["strict"] == 1).alias("base"))))
    return F.transform(order, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))


#: Code points of the pieces that a text is cut into, so that a place in it is found without going through all of it.
PIECE = 1000


def _between(pieces: Column, a: Column, b: Column) -> Column:
    """The code points from a to b of a text in pieces."""
    first, last = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
    at = lambda i: F.coalesce(F.get(pieces, i), F.lit(""))
    begin = (a % PIECE).cast("int")
    across = F.concat(F.substring(at(first), begin + 1, F.lit(PIECE)), F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substring(at(last), F.lit(1), (b % PIECE).cast("int")))
    return F.when(first == last, F.substring(at(first), begin + 1, (b - a).cast("int"))).otherwise(across)


def _masked(text: Column, spans: Column) -> Column:
    """The text with labels for spans, which come in order; a span that crosses earlier ones goes into their label."""

    def written(pieces: Column, ends: Column) -> Column:
        before = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0).cast("long"))
        label = lambda s, i: F.when((i == 0) | (s["start"] >= before(i)), F.concat(_between(pieces, before(i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.concat(F.array_join(F.transform(spans, label), ""), _between(pieces, before(F.size(ends)), F.length(text).cast("long")))

    ends = t.running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return t.let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda p: t.let(ends, lambda e: written(p, e)))


def mask(docs: DataFrame, scratch: Scratch | None = None, *, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents with all their columns; every span found is replaced by its kind, as in ``[EMAIL]``.

    The documents are written to the shared scratch folder with their candidates, so that texts are searched once.
    """
    out = "__pii_found"
    while out in docs.columns:
        out += "_"
    scratch = scratch or Scratch(docs.sparkSession, "pii")
    df = scratch.keep(candidates(docs, text_col, out), "candidates")
    model = fit(df, out)
    spans = F.array_sort(F.transform(F.filter(out, model.accepts), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text, new = F.col(text_col), f"{out}_text"
    any_span = F.size(out) > 0
    df = df.withColumn(new, F.when(any_span, t.let(spans, lambda x: _masked(text, x))).otherwise(text))
    columns = [F.col(new).alias(c) if c == text_col else F.when(any_span, F.length(new).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == chars_col else F.col(c) for c in docs.columns]
    return df.select(*columns)
