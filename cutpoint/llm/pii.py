"""Operator 1: personal data by patterns, checksums and context words, in SQL functions only.

Patterns propose spans over every whole text; Luhn (cards), mod-97 (bank account numbers)
and range rules (addresses, phone lengths) confirm them; words next to a span move its
score. The four base kinds keep every confirmed span whatever its score; the added kinds
(``iban``, ``ssn``) keep those that score ``MIN_SCORE`` or more. Failing matches are dropped
and not tried again at another length.

The patterns are written with possessive repeats and look-behinds so that the Java engine
neither recurses nor backtracks over long runs; they match what the plain forms match.
Offsets count code points, ends are exclusive: the texts between matches (``split``) and the
matches themselves add up to them.

Defined results: null and empty texts have no spans; an empty table gives an empty table;
repeated rows are treated alike; a null ``doc_id`` stays null; other columns are ignored by
``find`` and kept by ``redact``. Where spans overlap, ``redact`` writes the mark of the one
that starts first (the earlier kind on a tie) over their union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutpoint.llm.common import text_or_empty, whole

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this character, or match of this shorter pattern, has no match.
QUICK = {"email": "instr(text, '@') > 0", "phone": "instr(text, '+') > 0", "ssn": "instr(text, '-') > 0"}

CONFIRM = {
    "email": "true",
    "ip": "forall(split(value, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
    "card": "luhn_check(translate(value, ' -', ''))",
    "phone": "length(regexp_replace(value, '[^0-9]', '')) between 9 and 15",
    "iban": "mod97(value) = 1",
    "ssn": "substr(value, 1, 3) not in ('000', '666') and substr(value, 1, 1) <> '9' and substr(value, 5, 2) <> '00' and substr(value, 8, 4) <> '0000'",
}

#: Score of a confirmed span, and the words before or after it that raise or lower it.
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4}
RAISE = {"email": "mail|contact|write to", "ip": "address|host|server|client|login", "card": "card|visa|master|credit|debit|payment",
         "phone": "phone|call|tel|mobile|fax", "iban": "iban|bank|account|konto|cuenta|compte", "ssn": "ssn|social|security|tax"}
LOWER = {"email": "example", "ip": "version|release|build", "card": "order|serial|tracking|isbn", "phone": "version|serial",
         "iban": "serial|part", "ssn": "order|serial|part|item"}
STEP = 0.2
MIN_SCORE = 0.5
NEAR = 48

_MOD97 = ("aggregate(split(concat(substr({v}, 5), substr({v}, 1, 4)), ''), 0, (a, c) -> case when c = '' then a "
          "when c <= '9' then (a * 10 + ascii(c) - 48) % 97 else (a * 100 + ascii(c) - 55) % 97 end)")


def _confirm(kind: str) -> str:
    return CONFIRM[kind].replace("mod97(value)", _MOD97.format(v="replace(value, ' ', '')"))


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def _spans(kind: str) -> Column:
    """Confirmed spans of one kind from ``_hit_kind`` (matches) and ``_gap_kind`` (texts
    between them): an array of ``kind, start, end, score``."""
    hit, gap = f"_hit_{kind}", f"_gap_{kind}"
    near = f"lower(concat(right({gap}[i], {NEAR}), ' ', left({gap}[i + 1], {NEAR})))"
    walk = f"""
      aggregate(sequence(0, size({hit}) - 1),
        named_struct('at', 0, 'out', cast(array() as array<struct<start: int, end: int, value: string, near: string>>)),
        (s, i) -> named_struct('at', s.at + char_length({gap}[i]) + char_length({hit}[i]),
          'out', concat(s.out, array(named_struct('start', s.at + char_length({gap}[i]),
            'end', s.at + char_length({gap}[i]) + char_length({hit}[i]), 'value', {hit}[i], 'near', {near})))),
        s -> s.out)"""
    score = (f"{SCORE[kind]} + if(x.near rlike '{RAISE[kind]}', {STEP}, 0.0) - if(x.near rlike '{LOWER[kind]}', {STEP}, 0.0)")
    found = (f"transform(filter({walk}, x -> {_confirm(kind).replace('value', 'x.value')}), x -> named_struct('kind', '{kind}', "
             f"'start', x.start, 'end', x.end, 'score', cast({score} as double)))")
    if kind not in BASE:
        found = f"filter({found}, x -> x.score >= {MIN_SCORE})"
    none = "cast(array() as array<struct<kind: string, start: int, end: int, score: double>>)"
    return F.expr(f"if(size({hit}) > 0, {found}, {none})")


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_spans_<kind>`` for each kind to the rows, and ``_text`` (null as empty)."""
    out = docs.withColumn("_text", text_or_empty(text))
    matches, gaps, spans = {}, {}, {}
    for kind in KINDS:
        pattern, quick = _quoted(PATTERNS[kind]), QUICK.get(kind, "true").replace("text", "_text")
        matches[f"_hit_{kind}"] = F.expr(f"if({quick}, regexp_extract_all(_text, {pattern}, 0), cast(array() as array<string>))")
        gaps[f"_gap_{kind}"] = F.expr(f"if(size(_hit_{kind}) > 0, split(_text, {pattern}, -1), cast(array() as array<string>))")
        spans[f"_spans_{kind}"] = _spans(kind)
    return out.withColumns(matches).withColumns(gaps).withColumns(spans).drop(*matches, *gaps)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id``, and ``spans``, ``base``: arrays of ``kind, start,
    end, score``, by kind and then start; ``base`` has the four base kinds only."""
    found = with_spans(docs.select("doc_id", "text"))
    return found.select("doc_id", F.concat(*(f"_spans_{k}" for k in KINDS)).alias("spans"),
                        F.concat(*(f"_spans_{k}" for k in BASE)).alias("base"),
                        *(F.size(f"_spans_{k}").cast("long").alias(f"n_{k}") for k in KINDS))


def digests(docs: DataFrame) -> DataFrame:
    """The counts of the base kinds, the digest of the base spans, and all spans as text."""
    return find(docs).select(
        "doc_id", *(f"n_{k}" for k in BASE),
        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda x: x["score"])), F.lit(0.0)).alias("top_score"))


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span of ``text`` replaced by its kind in brackets,
    and ``n_chars``, where there is one, counted anew for changed texts; same columns."""
    order = "array_sort(concat(" + ", ".join(f"_spans_{k}" for k in KINDS) + "), (a, b) -> case when a.start <> b.start then a.start - b.start else 0 end)"
    clean = f"""
      aggregate({order}, named_struct('at', 0, 'out', cast(array() as array<string>)),
        (s, x) -> named_struct('at', greatest(s.at, x.end), 'out', if(x.start < s.at, s.out,
          concat(s.out, array(substring(_text, s.at + 1, x.start - s.at), concat('[', upper(x.kind), ']'))))),
        s -> array_join(concat(s.out, array(substring(_text, s.at + 1))), ''))"""
    some = F.expr(" + ".join(f"size(_spans_{k})" for k in KINDS) + " > 0")
    counted = ["n_chars"] if "n_chars" in docs.columns else []
    rows = with_spans(whole(docs, "text", *counted)).withColumn("_some", some).withColumn("_clean", F.when(F.col("_some"), F.expr(clean)))
    new = {"text": F.when(F.col("_some"), F.col("_clean")).otherwise(F.col("text"))}
    if counted:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("_some"), F.char_length("_clean").cast(kind)).otherwise(F.col("n_chars"))
    return rows.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
