"""Descriptions of empty forms from their names and places, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.context import _present

# Patterns, description, keywords and uses of each form type, in order of precedence.
TYPES = {
    "checklist": (
        [r"checklist", r"check.*list", r"ja.*checklist"],
        "This document is a {title} checklist for {purpose} in the {manual} policy manual.",
        ["checklist", "verification", "compliance", "audit", "steps"],
        ["staff guidance", "quality assurance", "procedure verification"],
    ),
    "template": (
        [r"template", r"form.*template", r"planning.*template"],
        "This document is a {title} template for {purpose} as part of {manual} policies.",
        ["template", "form", "planning", "documentation"],
        ["documentation", "planning", "record keeping"],
    ),
    "form": (
        [r"form(?!at)", r"sheet", r"log", r"record"],
        "This document is a {title} form for {purpose} supporting {manual} procedures.",
        ["form", "documentation", "record", "tracking"],
        ["data collection", "record keeping", "compliance documentation"],
    ),
    "audit": (
        [r"audit", r"assessment", r"evaluation"],
        "This document is an {title} audit tool for evaluating {purpose} in {manual}.",
        ["audit", "assessment", "evaluation", "quality", "compliance"],
        ["quality assurance", "compliance monitoring", "performance evaluation"],
    ),
    "inventory": (
        [r"inventory", r"utilization", r"tracking"],
        "This document is an {title} tracking sheet for monitoring {purpose} in {manual}.",
        ["inventory", "tracking", "monitoring", "utilization"],
        ["resource management", "inventory control", "utilization tracking"],
    ),
    "poster": (
        [r"poster", r"sign", r"notice"],
        "This document is a {title} poster providing information about {purpose} for {manual}.",
        ["poster", "information", "guidance", "reference"],
        ["staff reference", "patient information", "policy guidance"],
    ),
}

# Purposes and the words in a file name that speak for them.
PURPOSES = {
    "planning": ["planning", "plan"],
    "assessment": ["assessment", "evaluation", "audit"],
    "training": ["training", "education", "learning"],
    "safety": ["safety", "safe", "protection"],
    "medication": ["medication", "med", "drug"],
    "resident care": ["resident", "patient", "care"],
    "staff management": ["staff", "employee", "personnel"],
    "documentation": ["documentation", "record", "log"],
    "equipment": ["equipment", "device", "tool"],
    "communication": ["communication", "report", "notification"],
    "infection control": ["infection", "hygiene", "contamination"],
    "emergency": ["emergency", "code", "crisis"],
}
# Purposes that the manual, the section and the kind of form add; the first that fits of each row.
ADDED = {
    "policy_manual": [("care", "resident care"), ("emergency", "emergency response"), ("infection", "infection control")],
    "section": [("medication", "medication management"), ("safety", "safety procedures")],
    "file_name": [("checklist", "procedure verification"), ("template", "standardized documentation"), ("form", "information collection")],
}
# Uses that a purpose adds.
ADDED_USES = [("assessment", "quality improvement"), ("training", "staff education"), ("safety", "risk management"), ("resident", "patient care documentation")]


def _ladder(pairs: list[tuple[Column, object]]) -> Column:
    out = F.when(*pairs[0])
    for cond, value in pairs[1:]:
        out = out.when(cond, value)
    return out


def form_type(name: Column) -> Column:
    low = F.lower(name)
    return F.coalesce(_ladder([(F.regexp_like(low, F.lit("|".join(t[0]))), k) for k, t in TYPES.items()]), F.lit("form"))


def form_title(name: Column) -> Column:
    """The name without suffix and index code, in words; ``document`` if nothing is left."""
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    stem = F.regexp_replace(stem, r"^[A-Z]+\d*-[A-Z]\d+\.\d+(?:-[A-Z]\d+)?\s*", "")
    stem = F.lower(F.trim(F.regexp_replace(F.regexp_replace(stem, r"[_-]+", " "), r"\s+", " ")))
    return F.when(stem == "", "document").otherwise(stem)


def form_purpose(ctx: Column) -> Column:
    """One purpose as it is, two joined, of more the first; each word of the name that speaks counts."""
    low = F.lower(ctx["file_name"])
    found = [F.when(F.contains(low, F.lit(w)), p) for p, words in PURPOSES.items() for w in words]
    found += [_ladder([(F.contains(F.lower(ctx[field]), F.lit(w)), p) for w, p in pairs]) for field, pairs in ADDED.items()]
    all_ = F.array_compact(F.array(*found))
    n = F.size(all_)
    first, second = F.get(all_, F.lit(0)), F.get(all_, F.lit(1))
    return F.when(n == 0, "organizational procedures").when(n == 2, F.concat(first, F.lit(" and "), second)).otherwise(first)


def _by_type(kind: Column, values: dict[str, Column]) -> Column:
    return _ladder([(kind == k, v) for k, v in values.items()])


def description(ctx: Column) -> Column:
    kind, title, purpose = form_type(ctx["file_name"]), form_title(ctx["file_name"]), form_purpose(ctx)
    manual = F.when(_present(ctx["policy_manual"]), ctx["policy_manual"]).otherwise("organizational")

    def filled(template: str) -> Column:
        parts = [{"title": title, "purpose": purpose, "manual": manual}.get(p, F.lit(p)) for p in template.replace("{", "\0").replace("}", "\0").split("\0")]
        return F.concat(*parts)

    return F.concat(
        _by_type(kind, {k: filled(t[1]) for k, t in TYPES.items()}),
        F.when(_present(ctx["section"]), F.concat(F.lit(" This document is used within the "), ctx["section"], F.lit(" section."))).otherwise(""),
        F.when(_present(ctx["document_index"]), F.concat(F.lit(" Document reference: "), ctx["document_index"], F.lit("."))).otherwise(""),
    )


def _fixed(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def keywords(ctx: Column) -> Column:
    """Keywords of more than two characters, sorted and each once."""
    split = lambda c: F.coalesce(F.split(F.lower(c), r"\s+"), F.array().cast("array<string>"))
    words = F.concat(
        _by_type(form_type(ctx["file_name"]), {k: _fixed(t[2]) for k, t in TYPES.items()}),
        F.array_compact(F.array(F.lower(ctx["policy_acronym"]), F.lower(ctx["document_index"]))),
        split(ctx["policy_manual"]),
        F.split(form_purpose(ctx), r"\s+"),
        split(ctx["section"]),
    )
    return F.sort_array(F.array_distinct(F.filter(words, lambda w: F.char_length(w) > 2)))


def use_cases(ctx: Column) -> Column:
    purpose = form_purpose(ctx)
    base = _by_type(form_type(ctx["file_name"]), {k: _fixed(t[3]) for k, t in TYPES.items()})
    more = F.array_compact(F.array(*[F.when(F.contains(purpose, F.lit(w)), u) for w, u in ADDED_USES]))
    return F.sort_array(F.array_distinct(F.concat(base, more)))


def confidence(ctx: Column, size: Column) -> Column:
    """From 0.5 to 1: filled fields, a telling name and a plausible size add to it."""
    low, add = F.lower(ctx["file_name"]), F.lit(0.5)
    for f in ("policy_manual", "section", "document_index"):
        add = add + F.when(_present(ctx[f]), 0.1).otherwise(0.0)
    add = add + F.when(F.regexp_like(low, F.lit("checklist|template|form")), 0.15).otherwise(0.0)
    add = add + F.when((size > 10_000) & (size < 500_000), 0.1).when(size > 500_000, 0.05).otherwise(0.0)
    return F.least(add, F.lit(1.0))


def searchable_text(ctx: Column) -> Column:
    """The text of a described form's chunk: description, uses, keywords, file name and code."""
    listed = lambda words: F.array_join(words, ", ")
    words = keywords(ctx)
    return F.concat_ws(
        " ",
        description(ctx),
        F.concat(F.lit("This "), form_type(ctx["file_name"]), F.lit(" can be used for: "), listed(use_cases(ctx)), F.lit(".")),
        F.when(F.size(words) > 0, F.concat(F.lit("Related keywords: "), listed(words), F.lit("."))),
        F.concat(F.lit("Filename: "), ctx["file_name"]),
        F.when(_present(ctx["document_index"]), F.concat(F.lit("Document ID: "), ctx["document_index"])),
    )


def metadata(ctx: Column, size: Column) -> Column:
    """What a described form's chunk says about itself."""
    return F.struct(
        F.lit(True).alias("synthetic_description"),
        form_type(ctx["file_name"]).alias("document_type"),
        confidence(ctx, size).alias("confidence_score"),
        keywords(ctx).alias("generated_keywords"),
        use_cases(ctx).alias("use_cases"),
        description(ctx).alias("original_description"),
    )
