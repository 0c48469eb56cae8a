"""Personal data by weak supervision, in column expressions only.

Labelers (the form's own check, a gazetteer of endings, prefixes and codes, words before the span, words that speak
against it, the span's borders, a strict form) vote yes, no or nothing on every candidate span. Expectation-maximisation
over the counts of vote patterns estimates how reliable each labeler is for each kind; the resulting posteriors train a
logistic span classifier, whose weights become one column expression. The pattern table has at most
4 kinds x 2 forms x 3^5 votes rows, however large the corpus.

Fixed forms (email, ip, card, phone; validated matches) always stay. The classifier adds candidates of looser forms:
spelled-out mail addresses, phone numbers without a plus, IPv6 addresses, card numbers that a longer run of digits
hides. An added span passes its own form's check (such as the Luhn sum) and never overlaps a fixed one.

The fixed forms are written so that Java's matcher neither recurses nor backtracks over long runs: they give the same
matches as the plain patterns of the contract.

Defined cases: null text counts as empty and has no spans; each row is judged alone, so repeated rows repeat their
result; spans are ordered by start, then kind; without candidates nothing is learned and nothing added; other columns
are ignored by ``find_spans`` and kept by ``mask``, which leaves a null text null.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_rows, stage_table

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("check", "gazetteer", "context", "against", "border")
ROUNDS = 50
#: Kinds x forms x votes.
PATTERNS = len(KINDS) * 2 * 3 ** len(LABELERS)
CUT = 0.5
_LOCAL = "[A-Za-z0-9._%+-]"
FORMS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])[A-Za-z0-9.-]+?(?!\.?[A-Za-z0-9-])",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?=[ -]?[0-9])[0-9 -]+?(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = (
    rf"(?<!{_LOCAL}){_LOCAL}{{1,64}} ?[\[({{]at[\])}}] ?[A-Za-z0-9-]{{1,63}}(?:(?: ?[\[({{]dot[\])}}] ?| dot |\.)[A-Za-z0-9-]{{2,24}}){{1,4}}"
    rf"|(?<!{_LOCAL}){_LOCAL}{{1,64}} at [A-Za-z0-9-]{{1,63}}(?: dot [A-Za-z0-9-]{{2,24}}){{1,4}}"
    r"|(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
    r"|(?<![0-9])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{13,19})(?![0-9])"
    r"|(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
)
#: Top-level domains, card prefixes and country codes that speak for a span.
ENDINGS = r"(?i)(\.|dot[\])}]? ?)(com|org|net|edu|gov|info|io|de|fr|es|uk|eu|ch|at|be|it|nl)$"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)"
CODES = r"^\+?(1|7|20|27|3[0-46-9]|4[0-9]|5[1-8]|6[0-6]|8[1-6]|9[0-58])"
#: Words before a span that speak for it, by kind, and words that speak against any.
NEARBY = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|kontakt|correo|courriel|reach)\b",
    "ip": r"(?i)\b(ip|host|server|address|adresse|login|dirección)\b",
    "card": r"(?i)\b(card|credit|visa|mastercard|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(phone|tel|telephone|call|fax|mobile|telefon|téléphone|teléfono)\b",
}
AGAINST = r"(?i)\b(version|isbn|order|invoice|serial|sha|hash|token|build|rev)\b[^\n]{0,12}$"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_WORK = "duebook_pii_"
#: Characters of a text that are looked up together.
_CUT = 16_384


def _running(array: str) -> str:
    """Exclusive running sums of a short array."""
    step = "named_struct('sum', s.sum + x, 'out', concat(s.out, array(s.sum)))"
    return f"aggregate({array}, named_struct('sum', 0, 'out', cast(array() AS array<int>)), (s, x) -> {step}).out"


def _offsets(lengths: str) -> str:
    """Exclusive running sums, in blocks, so that thousands of matches stay cheap."""
    blocks = f"transform(sequence(0, cast((size({lengths}) - 1) DIV 256 AS int)), b -> slice({lengths}, b * 256 + 1, 256))"
    totals = f"transform({blocks}, b -> aggregate(b, 0, (s, x) -> s + x))"
    inner = _running("b")
    return f"flatten(zip_with({blocks}, {_running(totals)}, (b, o) -> transform({inner}, v -> v + o)))"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once a row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _blocks(array: str) -> str:
    """Runs of neighbouring spans, about as many as each holds, with the range of text that each covers."""
    width = f"greatest(32, cast(ceil(sqrt(size({array}))) AS int))"
    cut = f"transform(sequence(0, size({array}) - 1, w), i -> slice({array}, i + 1, w))"
    ranges = "transform(cut, b -> named_struct('spans', b, 'low', b[0].start, 'high', array_max(transform(b, y -> y.end))))"
    return _let("w", width, _let("cut", cut, ranges))


def _apart(loose: str, fixed: str) -> str:
    """The loose spans that meet no fixed one; blocks of fixed spans that lie elsewhere are passed over whole."""
    meets = "exists(bs, b -> b.low < x.end AND x.start < b.high AND exists(b.spans, y -> y.start < x.end AND x.start < y.end))"
    kept = _let("bs", _blocks(fixed), f"filter({loose}, x -> NOT {meets})")
    return f"CASE WHEN size({loose}) = 0 OR size({fixed}) = 0 THEN {loose} ELSE {kept} END"


def _replaced(text: str, spans: str, names: str) -> str:
    """``text`` with each of its ordered ``spans`` replaced by the name of its kind. A span that begins inside what
    lies before gives no name, and no text either as far as it reaches.

    What lies before a span ends at the largest end so far: that of whole blocks of spans and of its own block. The
    text is looked up in blocks too, so that no span counts characters from the start of a long text.
    """
    size = f"size({spans})"
    ends = f"transform({spans}, x -> x.end)"
    tops = f"transform(sequence(0, {size} - 1, w), i -> array_max(slice(ends, i + 1, w)))"
    before = "transform(tops, (t, b) -> coalesce(array_max(slice(tops, 1, b)), 0))"
    reached = "transform(ends, (e, i) -> greatest(get(before, i DIV w), coalesce(array_max(slice(ends, cast((i DIV w) * w + 1 AS int), i % w)), 0)))"
    at = "get(reached, i)"
    one = f"cast({at} DIV {_CUT} AS int)"
    other = f"cast(x.start DIV {_CUT} AS int)"
    within = f"substring(get(parts, {one}), {at} % {_CUT} + 1, x.start - {at})"
    across = (
        f"concat(substring(get(parts, {one}), {at} % {_CUT} + 1), array_join(slice(parts, {one} + 2, {other} - {one} - 1), ''),"
        f" substring(coalesce(get(parts, {other}), ''), 1, x.start % {_CUT}))"
    )
    gap = f"CASE WHEN {one} = {other} THEN {within} ELSE {across} END"
    pieces = f"transform({spans}, (x, i) -> CASE WHEN x.start < {at} THEN '' ELSE concat({gap}, {names}[x.kind]) END)"
    whole = f"concat(array_join({pieces}, ''), substring({text}, array_max(ends) + 1))"
    parts = f"transform(sequence(0, length({text}), {_CUT}), i -> substring({text}, i + 1, {_CUT}))"
    body = _let("before", before, _let("reached", reached, _let("parts", parts, whole)))
    return _let("ends", ends, _let("w", f"greatest(32, cast(ceil(sqrt({size})) AS int))", _let("tops", tops, body)))


def _valid(kind: str) -> str:
    """Condition on ``m``, a match of the fixed form."""
    digits = r"regexp_replace(m, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": rf"regexp_like(m, '^{_PART}(\\.{_PART}){{3}}$')",
        "card": f"length({digits}) BETWEEN 12 AND 19 AND luhn_check({digits})",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
    }[kind]


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _votes(kind: str) -> str:
    """One character for each labeler (1 yes, 0 no, - nothing) from ``m``, its context ``c`` and the text after, ``a``."""
    digits = r"regexp_replace(m, '[^0-9]', '')"
    check = {
        "email": "true",
        "ip": rf"NOT regexp_like(m, '(^|\\.)0[0-9]') AND NOT regexp_like(m, '^(0|255)\\.')",
        "card": f"luhn_check({digits})",
        "phone": f"length({digits}) BETWEEN 10 AND 13",
    }[kind]
    listed = {
        "email": f"CASE WHEN regexp_like(m, {_literal(ENDINGS)}) THEN '1' ELSE '-' END",
        "ip": r"CASE WHEN regexp_like(m, '^(10|127|169|172|192)\\.') THEN '1' ELSE '-' END",
        "card": f"CASE WHEN regexp_like(m, {_literal(ISSUERS)}) THEN '1' ELSE '0' END",
        "phone": f"CASE WHEN regexp_like(m, {_literal(CODES)}) THEN '1' ELSE '-' END",
    }[kind]
    near = f"CASE WHEN regexp_like(c, {_literal(NEARBY[kind])}) THEN '1' ELSE '-' END"
    against = f"CASE WHEN regexp_like(c, {_literal(AGAINST)}) THEN '0' ELSE '-' END"
    border = "CASE WHEN regexp_like(c, '[A-Za-z0-9]$') OR regexp_like(a, '^[A-Za-z0-9]') THEN '0' ELSE '1' END"
    return f"concat(CASE WHEN {check} THEN '1' ELSE '0' END, {listed}, {near}, {against}, {border})"


def _candidates(documents: DataFrame, text: str) -> DataFrame:
    """Adds ``base`` and ``loose``: arrays of (start, end, kind, votes), kind as a number; all other columns stay."""
    frame = documents.withColumn(_WORK + "text", F.coalesce(F.col(text), F.lit("")))
    t = _WORK + "text"
    need = {"email": f"contains({t}, '@')", "ip": "true", "card": "true", "phone": f"contains({t}, '+')", "loose": "true"}
    patterns = FORMS | {"loose": LOOSE}
    for kind, pattern in patterns.items():
        found = f"CASE WHEN {need[kind]} THEN regexp_extract_all({t}, {_literal(pattern)}, 0) ELSE cast(array() AS array<string>) END"
        frame = frame.withColumn(f"{_WORK}{kind}_found", F.expr(found))
    for kind, pattern in patterns.items():
        f = f"{_WORK}{kind}_found"
        frame = frame.withColumn(f"{_WORK}{kind}_gaps", F.expr(f"CASE WHEN size({f}) > 0 THEN split({t}, {_literal(pattern)}, -1) END"))
    for kind in patterns:
        f, g = f"{_WORK}{kind}_found", f"{_WORK}{kind}_gaps"
        lengths = f"transform(sequence(0, size({f}) - 1), i -> length({f}[i]) + length({g}[i]))"
        frame = frame.withColumn(f"{_WORK}{kind}_lengths", F.expr(f"CASE WHEN size({f}) > 0 THEN {lengths} END"))
    for kind in patterns:
        f, g, n = (f"{_WORK}{kind}_{x}" for x in ("found", "gaps", "lengths"))
        frame = frame.withColumn(f"{_WORK}{kind}_starts", F.expr(f"CASE WHEN size({f}) > 0 THEN {_offsets(n)} END"))
    for kind in patterns:
        f, g, o = (f"{_WORK}{kind}_{x}" for x in ("found", "gaps", "starts"))
        span = (
            f"named_struct('start', {o}[i] + length({g}[i]), 'end', {o}[i] + length({g}[i]) + length({f}[i]),"
            f" 'm', {f}[i], 'c', right({g}[i], 40), 'a', left({g}[i + 1], 1))"
        )
        empty = "cast(array() AS array<struct<start:int,end:int,m:string,c:string,a:string>>)"
        frame = frame.withColumn(
            f"{_WORK}{kind}_spans", F.expr(f"CASE WHEN size({f}) > 0 THEN transform(sequence(0, size({f}) - 1), i -> {span}) ELSE {empty} END")
        )
    parts = []
    for number, kind in enumerate(KINDS):
        condition = _on(_valid(kind))
        votes = _on(_votes(kind))
        parts.append(
            f"transform(filter({_WORK}{kind}_spans, x -> {condition}), x -> named_struct('start', x.start, 'end', x.end, 'kind', {number}, 'votes', {votes}))"
        )
    frame = frame.withColumn("base", F.expr(f"array_sort(concat({', '.join(parts)}))"))
    x = f"{_WORK}loose_spans"
    number = (
        "CASE WHEN contains(x.m, ':') THEN 1 WHEN regexp_like(x.m, '[A-Za-z]') THEN 0"
        " WHEN length(regexp_replace(x.m, '[^0-9]', '')) > 10 THEN 2 ELSE 3 END"
    )
    votes = "CASE " + " ".join(f"WHEN ({number}) = {i} THEN {_on(_votes(k))}" for i, k in enumerate(KINDS)) + " END"
    frame = frame.withColumn("loose", F.expr(f"transform({_apart(x, 'base')}, x -> named_struct('start', x.start, 'end', x.end, 'kind', {number}, 'votes', {votes}))"))
    return frame.drop(*[c for c in frame.columns if c.startswith(_WORK)])


def _on(condition: str) -> str:
    """A condition on m, c and a, turned to one on the fields of x."""
    for name in ("m", "c", "a"):
        condition = condition.replace(f"({name},", f"(x.{name},")
    return condition


def reliabilities(patterns: list[tuple[int, bool, str, int]], rounds: int = ROUNDS) -> list[float]:
    """Posterior of each pattern (kind, fixed form, votes, count): two-class EM with a vote table per kind and labeler.

    Starts from the share of yes votes. The fixed form is a sixth labeler that only says yes.
    """
    def seen(fixed: bool, votes: str) -> str:
        return votes + ("1" if fixed else "-")

    posterior = []
    for _, fixed, votes, _ in patterns:
        yes, no = seen(fixed, votes).count("1"), votes.count("0")
        posterior.append((yes + 0.5) / (yes + 2 * no + 1))
    for _ in range(rounds):
        table: dict[tuple, float] = {}
        prior: dict[tuple, float] = {}
        for (kind, fixed, votes, count), p in zip(patterns, posterior, strict=True):
            for truth, share in ((1, p), (0, 1 - p)):
                prior[kind, truth] = prior.get((kind, truth), 1.0) + share * count
                for place, vote in enumerate(seen(fixed, votes)):
                    table[kind, truth, place, vote] = table.get((kind, truth, place, vote), 0.0) + share * count
        fresh = []
        for kind, fixed, votes, _ in patterns:
            logs = []
            for truth in (1, 0):
                value = math.log(prior[kind, truth])
                for place, vote in enumerate(seen(fixed, votes)):
                    known = {"1": 2.0 if truth else 0.5, "0": 0.5 if truth else 2.0, "-": 1.0}
                    value += math.log((table.get((kind, truth, place, vote), 0.0) + known[vote]) / (prior[kind, truth] + 2.5))
                logs.append(value)
            fresh.append(1 / (1 + math.exp(max(-500.0, min(500.0, logs[1] - logs[0])))))
        posterior = fresh
    return posterior


def _features(kind: str, votes: str) -> list[str]:
    flags = [f"cast({kind} = {i} AS double)" for i in range(len(KINDS))]
    for place in range(len(LABELERS)):
        flags += [f"cast(substring({votes}, {place + 1}, 1) = '{v}' AS double)" for v in "10"]
    return flags


def learn(candidates: DataFrame) -> list[float] | None:
    """Intercept and weights of the span classifier; None without candidates."""
    rows = candidates.select(F.explode(F.expr("concat(transform(base, x -> struct(x.kind, true AS fixed, x.votes)), transform(loose, x -> struct(x.kind, false AS fixed, x.votes)))")).alias("x"))
    counted = few_rows(rows.groupBy("x.kind", "x.fixed", "x.votes").count(), PATTERNS)
    patterns = sorted((r.kind, r.fixed, r.votes, r["count"]) for r in counted)
    if not patterns:
        return None
    table = []
    for (kind, _, votes, count), p in zip(patterns, reliabilities(patterns), strict=True):
        table += [(kind, votes, 1.0, p * count), (kind, votes, 0.0, (1 - p) * count)]
    frame = candidates.sparkSession.createDataFrame(table, "kind int, votes string, label double, weight double")
    flags = _features("kind", "votes")
    wide = frame.select("label", (F.col("weight") + 1e-6).alias("weight"), *[F.expr(f).alias(f"f{i}") for i, f in enumerate(flags)]).coalesce(1)
    wide = VectorAssembler(inputCols=[f"f{i}" for i in range(len(flags))], outputCol="features").transform(wide)
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(wide)
    return [float(model.intercept), *map(float, model.coefficients)]


def _accepted(weights: list[float] | None, cut: float) -> Column:
    """The loose candidates that pass their own form's check and that the classifier accepts."""
    if weights is None:
        return F.expr("filter(loose, x -> false)")
    terms = [repr(weights[0]) + "D"] + [f"({w!r}D) * {f}" for w, f in zip(weights[1:], _features("x.kind", "x.votes"), strict=True)]
    return F.expr(f"filter(loose, x -> startswith(x.votes, '1') AND 1 / (1 + exp(-({' + '.join(terms)}))) >= {cut!r}D)")


def _joined(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform(array_sort({spans}, (l, r) -> CASE WHEN l.start <> r.start THEN l.start - r.start ELSE l.kind - r.kind END), x -> concat({names}[x.kind], ':', x.start, ':', x.end)), ',')"


def find_spans(documents: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, n_<kind> of the fixed forms, base (their spans as kind:start:end) and spans (with the added ones)."""
    narrow = documents.select("doc_id", "text")
    staged = stage_table(_candidates(narrow, "text").select("doc_id", "base", "loose"), "spans")
    found = staged.withColumn("added", _accepted(learn(staged), cut))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {i})) AS bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.expr(_joined("base")).alias("base"), F.expr(_joined("concat(base, added)")).alias("spans"))


def mask(documents: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; n_chars, where present, follows the text."""
    weights = learn(stage_table(_candidates(documents.select("text"), "text").select("base", "loose"), "spans"))
    held = documents.select(F.struct("*").alias("row"), F.col("text").alias("plain"))
    found = _candidates(held, "plain").withColumn("added", _accepted(weights, cut))
    ordered = "array_sort(concat(base, added), (l, r) -> CASE WHEN l.start <> r.start THEN l.start - r.start ELSE r.end - l.end END)"
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    pieces = _let("spans", ordered, _replaced("plain", "spans", names))
    masked = found.withColumn("masked", F.expr(f"CASE WHEN plain IS NULL OR size(base) + size(added) = 0 THEN plain ELSE {pieces} END"))
    kind = documents.schema["n_chars"].dataType if "n_chars" in documents.columns else None
    out = []
    for name in documents.columns:
        if name == "text":
            out.append(F.col("masked").alias("text"))
        elif name == "n_chars":
            out.append(F.when(F.col("masked") == F.col("plain"), F.col("row.n_chars")).otherwise(F.length("masked")).cast(kind).alias("n_chars"))
        else:
            out.append(F.col("row")[name].alias(name))
    return masked.select(*out)
