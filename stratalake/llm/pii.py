"""Personal data by candidate gradient boosting, in DataFrame functions alone.

Base patterns with checks (octets, Luhn digits, digit counts) give spans that are always
kept. Written-out addresses (``jane [at] mail [dot] com``), which are e-mail addresses
once their words in brackets are read as signs, are always added, as spans of kind
``contact``. High-recall generators propose further spans, which may overlap: what may
be an address, and any run of at least ``LEAST_DIGITS`` digits with separators. Each
proposal is described by format features (digits, groups, separators, shape) and context
features (what touches it, what sign stands before it). Boosted trees, one model per
generator, learn from the proposals of all texts, each value counted once a feature vector.

Positive examples are the known spans and, beyond the base formats, proposals whose value
there is evidence for: a known span elsewhere has it, or a word in front of one of its
occurrences announces it. Neither is a feature, so the trees learn what such values look
like and find others of that look without a word before them. Not every value is
announced: how many are is measured on the known spans, and how many are announced by
chance on proposals that stand within a longer word. From both follows, for every score,
what share of the proposals that are not known spans is personal data. Values that were
held out of the fit calibrate the threshold so that this share is ``PRECISION`` at least;
proposals above it are added as spans of kind ``contact`` or ``number``. Without announced
known spans every proposal counts as what its own evidence says.

Proposals are counted by value and feature vector in Spark, then by feature vector, so
what reaches the driver to be fitted is bounded by the features' ranges. Scores are
``when`` expressions. A text's spans are found and joined in its own row: no shuffle but
those of the counts. Patterns repeat groups possessively, which the regular-expression
engine does without recursion, and begin only where a run of their characters does or
where the last match ended, so that very long runs are matched too, and read once.

Offsets are code points, ends exclusive. Defined results: null and empty texts have no
spans; repeated rows are handled once each; without positive or without negative
proposals nothing but written-out addresses is added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .boosting import Boosted, fit, unlabelled_threshold

#: Where a run begins, or the last match ended: from any later place the run ends alike.
_RUN = r"(?:(?<![A-Za-z0-9._%+-])|\G)"
#: The kinds in their order and the base patterns. Groups are repeated
#: possessively; nothing follows them, so they match as they would greedily.
BASE = {
    "email": _RUN + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to be searched for a kind at all.
_NEEDED = {
    "email": lambda text: text.contains("@"),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"(?:[0-9][\x20-]?){13}[0-9]"),
    "phone": lambda text: text.rlike(r"\+[0-9]"),
    "contact": lambda text: text.contains("@") | text.rlike(r"(?i)[(\[{]\x20?at\x20?[)\]}]"),
    "written": lambda text: text.rlike(r"(?i)[(\[{]\x20?(?:at|dot)\x20?[)\]}]"),
    "number": lambda text: text.rlike(r"(?:[0-9][\x20().\-/]{0,3}){6}[0-9]"),
}
PROPOSED = {
    "contact": r"(?i)" + _RUN + r"[A-Z0-9._%+-]++\x20?(?:@|[(\[{]\x20?at\x20?[)\]}])\x20?"
    r"[A-Z0-9-]++(?:\x20?(?:\.|[(\[{]\x20?dot\x20?[)\]}])\x20?[A-Z0-9-]++)*+",
    "number": r"[+(]?[0-9](?:[\x20().\-/]{0,3}+[0-9])++",
}
_AT = r"\x20?[(\[{]\x20?at\x20?[)\]}]\x20?"
_DOT = r"\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?"
#: E-mail addresses with some of their signs as words in brackets, or without any.
WRITTEN = (
    rf"(?i)(?<!dot\x20?[)\]}}]\x20?){_RUN}[A-Z0-9._%+-]++(?:{_DOT}[A-Z0-9._%+-]++)*+(?:\x20?@\x20?|{_AT})"
    rf"[A-Z0-9-]++(?:(?:\.|{_DOT})[A-Z0-9-]++)++"
)
KINDS = (*BASE, *PROPOSED)
#: What needs no model.
KNOWN = (*BASE, "written")
#: Least share of personal data among the added proposals above a threshold.
PRECISION = 0.9
#: Digits of a proposed number, at least.
LEAST_DIGITS = 7
#: Announced values from which their share is measured.
LEAST_ANNOUNCED = 10
#: Characters of context before a proposal.
BEFORE = 24
#: Words that announce personal data.
CONTEXT = {
    "contact": r"(?i)\b(?:e-?mail|mail|contact|write|reply|address|adresse|kontakt|correo"
    r"|courriel|contacto|direcci\u00f3n)\b",
    "number": r"(?i)\b(?:tel|phone|call|fax|mobile|cell|contact|card|visa|account|ssn|ip|host"
    r"|passport|iban|telefon|handy|konto|karte|tel\u00e9fono|m\u00f3vil|cuenta|tarjeta"
    r"|t\u00e9l|t\u00e9l\u00e9phone|portable|compte|carte)\b",
}
_CHUNK = 64


def _bound(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def running_totals(numbers: Column) -> Column:
    """Totals of an array of ints up to each place, by chunks: no long sum is repeated."""

    def chunked(n: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(n) - 1) / _CHUNK).cast("int"))
        chunks = F.transform(places, lambda k: F.slice(n, k * _CHUNK + 1, F.lit(_CHUNK)))
        return _bound(chunks, lambda c: _bound(F.transform(c, _total), lambda t: joined(c, t)))

    def joined(chunks: Column, totals: Column) -> Column:
        return F.flatten(
            F.transform(
                chunks,
                lambda chunk, k: _bound(
                    _total(F.slice(totals, F.lit(1), k)),
                    lambda before: F.transform(
                        chunk, lambda _, i: before + _total(F.slice(chunk, F.lit(1), i + 1))
                    ),
                ),
            )
        )

    empty = F.array().cast("array<int>")
    return F.when(F.size(numbers) == 0, empty).otherwise(_bound(numbers, chunked))


def _found(kind: str, pattern: str) -> Column:
    """All matches of a pattern: structs of start, end and value."""
    text = F.col("text")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(m: Column, g: Column) -> Column:
        lengths = F.zip_with(
            F.slice(g, F.lit(1), F.size(m)),
            m,
            lambda gap, match: F.length(gap) + F.length(match),
        )
        return F.zip_with(
            running_totals(lengths),
            m,
            lambda end, match: F.struct(
                (end - F.length(match)).alias("start"), end.alias("end"), match.alias("value")
            ),
        )

    spans = _bound(matches, lambda m: _bound(gaps, lambda g: placed(m, g)))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(_NEEDED[kind](text), spans).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    def weighed(place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(place % 2 == 1, twice).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return _total(F.transform(places, weighed)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        octet = lambda x: F.regexp_replace(x, "^0+", "")
        small = lambda x: (F.length(octet(x)) < 3) | (
            (F.length(octet(x)) == 3) & (octet(x) <= "255")
        )
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        size = F.length(_digits(value))
        return F.when((size >= 14) & (size <= 19), passes_luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    if kind == "written":
        return value.rlike(rf"(?i)(?:{_AT}|{_DOT})")
    return F.lit(True)


def _count_of(value: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kept}]", ""))


def _capped(count: Column, most: int) -> Column:
    return F.least(count, F.lit(most)).cast("int")


def _eligible(kind: str, span: Column) -> Column:
    """Whether a proposal is one at all: what is shorter is neither learned nor added."""
    return F.length(_digits(span["value"])) >= LEAST_DIGITS if kind == "number" else F.lit(True)


def _key(kind: str, value: Column) -> Column:
    """The value without its format: digits, or an address with its signs read."""
    if kind == "number":
        return _digits(value)
    signs = F.regexp_replace(F.regexp_replace(value, rf"(?i){_AT}", "@"), rf"(?i){_DOT}", ".")
    return F.lower(F.regexp_replace(signs, r"\x20", ""))


def _features(kind: str, span: Column) -> dict[str, Column]:
    """Small whole numbers; their ranges bound the number of distinct vectors."""
    value, before, after = span["value"], span["before"], span["after"]
    flag = lambda condition: condition.cast("int")
    groups = F.size(F.split(F.regexp_replace(value, "^[^0-9]+", ""), "[^0-9]+"))
    around = {
        "touched_before": flag(before.rlike(r"[\p{L}\p{N}_./-]$")),
        "touched_after": flag(after.rlike(r"^[\p{L}\p{N}_/-]")),
        "assigned": flag(before.rlike(r"[=#$]\x20?$")),
    }
    if kind == "contact":
        return around | {
            "first_letters": _capped(F.length(F.regexp_extract(value, "^([A-Za-z]*)", 1)), 7),
            "last_letters": _capped(F.length(F.regexp_extract(value, "([A-Za-z]*)$", 1)), 7),
            "dots": _capped(_count_of(F.regexp_extract(value, r"@(.*)$", 1), "."), 3),
            "spaces": _capped(_count_of(value, r"\x20"), 2),
        }
    return around | {
        "digits": _capped(F.length(_digits(value)), 20),
        "groups": _capped(groups, 6),
        "first_group": _capped(F.length(F.regexp_extract(value, "([0-9]+)", 1)), 5),
        "last_group": _capped(F.length(F.regexp_extract(value, "([0-9]+)$", 1)), 5),
        "dots": _capped(_count_of(value, "."), 4),
        "dashes": _capped(_count_of(value, r"\-"), 4),
        "parentheses": _capped(_count_of(value, "()"), 2),
        "slashes": _capped(_count_of(value, "/"), 2),
    }


_PROPOSAL = (
    "array<struct<start:int,end:int,value:string,before:string,after:string,is_known:boolean>>"
)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with an array of spans per known kind and of proposals per generator.

    The new columns begin with ``pii_``; ``docs`` has a ``text`` and no such columns.
    """
    found = docs.withColumns(
        {
            f"pii_{k}": _found(k, p)
            for k, p in (*BASE.items(), ("written", WRITTEN), *PROPOSED.items())
        }
    )

    def passing(kind: str) -> Column:
        return F.filter(f"pii_{kind}", lambda span: _valid(kind, span["value"]))

    checked = found.withColumns({f"pii_{k}": passing(k) for k in KNOWN})
    known = reduce(lambda a, b: F.concat(a, b), (F.col(f"pii_{k}") for k in KNOWN))
    with_known = checked.withColumn("pii_known", known)

    def proposal(span: Column) -> Column:
        start = span["start"]
        overlaps = F.exists(
            "pii_known", lambda b: (b["start"] < span["end"]) & (start < b["end"])
        )
        return F.struct(
            start.alias("start"),
            span["end"].alias("end"),
            span["value"].alias("value"),
            F.substring(
                "text", F.greatest(start - BEFORE, F.lit(0)) + 1, F.least(start, F.lit(BEFORE))
            ).alias("before"),
            F.substring("text", span["end"] + 1, F.lit(1)).alias("after"),
            overlaps.alias("is_known"),
        )

    return with_known.withColumns({f"pii_{k}": F.transform(f"pii_{k}", proposal) for k in PROPOSED})


def texts(docs: DataFrame) -> DataFrame:
    """``docs`` with null texts empty."""
    return docs.withColumn("text", F.coalesce("text", F.lit("")))


def examples(docs: DataFrame, kind: str) -> DataFrame:
    """A generator's proposals counted by features and evidence, each value once a vector.

    ``is_known``: a known span. ``evident``: one, or a value that is known or announced
    somewhere. ``announced``: a value that is announced somewhere. ``calibrates``: a value
    that is held out of the fit.
    """
    found = located(texts(docs).select("text"))
    # A plain explode would search every text once more, to leave out those without.
    spans = found.select(F.explode_outer(f"pii_{kind}").alias("span")).where("span is not null")
    span = F.col("span")
    features = _features(kind, span)
    flag = lambda condition: F.max(condition.cast("int"))
    values = (
        spans.where(_eligible(kind, span))
        .groupBy(
            F.xxhash64(_key(kind, span["value"])).alias("value"),
            *(c.alias(n) for n, c in features.items()),
            span["is_known"].alias("is_known"),
        )
        .agg(flag(span["before"].rlike(CONTEXT[kind])).alias("announced"))
    )
    # A value has few vectors, however often it occurs.
    everywhere = Window.partitionBy("value")
    seen = values.withColumns(
        {
            "announced": F.max("announced").over(everywhere) == 1,
            "evident": F.max(F.col("is_known").cast("int")).over(everywhere) == 1,
        }
    )
    by = [*features, "is_known", "evident", "announced", "calibrates"]
    return (
        seen.withColumn("evident", F.col("evident") | F.col("announced"))
        .withColumn("calibrates", F.pmod("value", F.lit(4)) == 0)
        .groupBy(*by)
        .count()
        .orderBy(*by)
    )


def _share(rows: list, chosen) -> float | None:
    """The announced share of the chosen rows, if enough of them are announced to tell."""
    total = sum(r["count"] for r in rows if chosen(r))
    announced = sum(r["count"] for r in rows if chosen(r) and r["announced"])
    return announced / total if announced >= LEAST_ANNOUNCED else None


def train(docs: DataFrame, precision: float = PRECISION) -> dict[str, tuple[Boosted, float]]:
    """Each generator's model and threshold, from the proposals of all texts."""
    models = {}
    for kind in PROPOSED:
        rows = examples(docs, kind).collect()
        if not rows:
            continue
        evidence = ("is_known", "evident", "announced", "calibrates", "count")
        names = [n for n in rows[0].asDict() if n not in evidence]
        touched = lambda r: r["touched_before"] or r["touched_after"]
        share = _share(rows, lambda r: r["is_known"]) or 1.0
        chance = _share(rows, lambda r: not r["is_known"] and touched(r)) or 0.0
        vector = lambda r: {n: r[n] for n in names}
        learn = [(vector(r), int(r["evident"]), r["count"]) for r in rows if not r["calibrates"]]
        held = [
            (vector(r), r["is_known"], int(r["evident"]), r["count"])
            for r in rows
            if r["calibrates"]
        ]
        if len({label for _, label, _ in learn}) == 2 and held and chance < share:
            model = fit(learn)
            limit = unlabelled_threshold(model, held, precision, share, chance)
            if limit is not None:
                models[kind] = (model, limit)
    return models


def with_spans(docs: DataFrame, models: dict[str, tuple[Boosted, float]]) -> DataFrame:
    """``docs`` with ``pii_base`` and ``pii_spans``: structs of start, kind's place and end."""
    found = located(texts(docs))

    def plain(kind: str):
        place = KINDS.index(kind)
        return lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("kind"), s["end"].alias("end")
        )

    def chosen(kind: str) -> Column:
        model, limit = models[kind]
        return F.filter(
            f"pii_{kind}",
            lambda s: ~s["is_known"]
            & _eligible(kind, s)
            & (model.column(_features(kind, s)) >= limit - 1e-9),
        )

    base = F.concat(*(F.transform(f"pii_{k}", plain(k)) for k in BASE))
    added = [F.transform("pii_written", plain("contact"))]
    added += [F.transform(chosen(kind), plain(kind)) for kind in models]
    spans = found.withColumn("pii_spans", F.array_distinct(F.array_sort(F.concat(base, *added))))
    kept = spans.withColumn("pii_base", F.array_sort(base))
    return kept.drop("pii_known", "pii_written", *(f"pii_{k}" for k in PROPOSED))


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, models: dict[str, tuple[Boosted, float]]) -> DataFrame:
    """Per document: base counts, the hash of the base spans, and all spans."""
    found = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), models)
    return found.select(
        "doc_id",
        *(F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(written(F.col("pii_base")), 256).alias("base_sha256"),
        written(F.col("pii_spans")).alias("spans"),
    )


def redact(docs: DataFrame, models: dict[str, tuple[Boosted, float]]) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in capitals, in brackets.

    Spans that overlap are replaced together, by the kind of the first. Texts without
    spans stay as they are, null texts included.
    """
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))
    found = with_spans(row, models)
    state = "struct<out:array<struct<start:int,kind:int,end:int>>>"
    merged = F.aggregate(
        "pii_spans",
        F.struct(F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out")).cast(
            state
        ),
        lambda acc, s: F.struct(
            F.when(
                (F.size(acc["out"]) > 0) & (s["start"] < F.get(acc["out"], F.size(acc["out"]) - 1)["end"]),
                F.concat(
                    F.slice(acc["out"], F.lit(1), F.size(acc["out"]) - 1),
                    F.array(
                        F.struct(
                            F.get(acc["out"], F.size(acc["out"]) - 1)["start"].alias("start"),
                            F.get(acc["out"], F.size(acc["out"]) - 1)["kind"].alias("kind"),
                            F.greatest(
                                F.get(acc["out"], F.size(acc["out"]) - 1)["end"], s["end"]
                            ).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(F.concat(acc["out"], F.array(s)))
            .alias("out")
        ),
        lambda acc: acc["out"],
    )
    cut = found.withColumn("pii_merged", merged)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    last = F.get("pii_merged", F.size("pii_merged") - 1)
    pieces = F.transform(
        "pii_merged",
        lambda s, i: _bound(
            F.when(i > 0, F.get("pii_merged", i - 1)["end"]).otherwise(0),
            lambda from_: F.concat(
                F.substring("text", from_ + 1, s["start"] - from_), F.get(names, s["kind"])
            ),
        ),
    )
    whole = F.concat(
        F.array_join(pieces, ""),
        F.substring("text", last["end"] + 1, F.length("text")),
    )
    clean = F.when(F.size("pii_merged") == 0, F.col("row.text")).otherwise(whole)
    return cut.withColumn("pii_clean", clean).select(
        *(
            F.col("pii_clean").alias("text") if c == "text" else F.col(f"row.{c}")
            for c in docs.columns
        )
    )


def with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, where there is one, set to the length of ``text``."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))
