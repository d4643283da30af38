"""What a document's path and name say about it, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import config

# Document types by patterns in the file name, in order of precedence.
TYPE_PATTERNS = {
    "policy": [r"policy", r"procedure", r"standard"],
    "form": [r"form", r"checklist", r"template"],
    "guide": [r"guide", r"manual", r"handbook"],
    "training": [r"training", r"education", r"learning"],
    "flowchart": [r"flowchart", r"flow\s*chart", r"process\s*flow"],
    "reference": [r"reference", r"quick\s*ref", r"job\s*aid"],
}

SUPPORTED = (".pdf", ".docx", ".doc")


def relative_path(path: Column, root: str, strict: bool = False) -> Column:
    """The path below ``root``. One that lies elsewhere stays whole, or ends the job if ``strict``."""
    root = root.rstrip("/") + "/"
    outside = F.raise_error(F.concat(path, F.lit(f" is not below {root}"))).cast("string") if strict else path
    return F.when(F.startswith(path, F.lit(root)), F.substring(path, len(root) + 1, 1 << 30)).when(path.isNotNull(), outside)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """Lower-case suffix with its dot; empty without one."""
    return F.lower(F.regexp_extract(file_name(path), r"(\.[^.]+)$", 1))


def is_supported(path: Column, suffixes: tuple[str, ...] = SUPPORTED) -> Column:
    return extension(path).isin(*suffixes)


def acronym(manual: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in config.MANUALS.items() for x in kv]), manual)


def document_index(name: Column) -> Column:
    """A code such as ``CARE1-P10.01-T3`` at the start of the name, in upper case; null without one."""
    codes = "|".join(sorted(config.MANUALS.values()))
    found = F.regexp_extract(name, rf"(?i)^((?:{codes})\d*-[A-Z]\d+\.\d+(?:-[A-Z]\d+)?)", 1)
    return F.nullif(F.upper(found), F.lit(""))


def document_type(name: Column) -> Column:
    """The first type that a pattern in the name speaks for; null without one."""
    out = None
    for kind, patterns in TYPE_PATTERNS.items():
        cond = F.regexp_like(F.lower(name), F.lit("|".join(patterns)))
        out = F.when(cond, kind) if out is None else out.when(cond, kind)
    return out


def synthetic_index(code: Column, additional: Column, number: Column) -> Column:
    return F.format_string("%s-%s-%03d", F.coalesce(code, F.lit("UNK")), F.when(additional, "ADDL").otherwise("MISC"), number)


def context(path: Column, root: str) -> Column:
    """Manual, acronym, section, subsection, index, type and hierarchy of a path.

    The first three parts below the root are manual, section and subsection, so a file that lies higher gives its own
    name to one of them.
    """
    parts = F.split(relative_path(path, root), "/")
    name = file_name(path)
    section = F.get(parts, F.lit(1))
    additional = F.coalesce(F.contains(F.lower(section), F.lit("additional")) & F.contains(F.lower(section), F.lit("resource")), F.lit(False))
    return F.struct(
        relative_path(path, root).alias("relative_path"),
        name.alias("file_name"),
        F.get(parts, F.lit(0)).alias("policy_manual"),
        acronym(F.get(parts, F.lit(0))).alias("policy_acronym"),
        section.alias("section"),
        F.get(parts, F.lit(2)).alias("subsection"),
        document_index(name).alias("document_index"),
        additional.alias("is_additional_resource"),
        document_type(name).alias("document_type"),
        F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))).alias("hierarchy_path"),
    )


def _present(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def tags(ctx: Column) -> Column:
    """Search tags, sorted and each once."""
    low = F.lower(ctx["file_name"])
    snake = lambda c: F.when(_present(c), F.replace(F.lower(c), F.lit(" "), F.lit("_")))
    has = lambda *needles: F.greatest(*[F.contains(low, F.lit(n)) for n in needles]) if len(needles) > 1 else F.contains(low, F.lit(needles[0]))
    index = ctx["document_index"]
    found = [
        snake(ctx["policy_manual"]),
        F.lower(ctx["policy_acronym"]),
        snake(ctx["section"]),
        ctx["document_type"],
        F.when(ctx["is_additional_resource"], "additional_resource"),
        F.when(index.isNotNull(), "indexed_document").otherwise("non_indexed_document"),
        F.concat(F.lit("index_"), F.lower(index)),
        *[F.when(has(w), w) for w in ("form", "checklist", "template", "guide")],
        F.when(has("flowchart", "flow chart"), "flowchart"),
    ]
    return F.sort_array(F.array_distinct(F.array_compact(F.array(*found))))


def completeness(ctx: Column) -> Column:
    """The share of eight fields that are filled."""
    fields = ["policy_manual", "policy_acronym", "section", "subsection", "document_index", "document_type", "file_name"]
    total = F.when(F.size(ctx["hierarchy_path"]) > 0, 1).otherwise(0)
    for f in fields:
        total = total + F.when(_present(ctx[f]), 1).otherwise(0)
    return total / 8.0


def validate(ctx: Column) -> Column:
    """(is_valid, issues, warnings)."""
    issues = F.array_compact(F.array(F.when(~_present(ctx["policy_manual"]), "Missing policy manual identification")))
    warnings = F.array_compact(
        F.array(
            F.when(~_present(ctx["policy_acronym"]), "Could not map policy manual to acronym"),
            F.when(~_present(ctx["document_index"]) & ~ctx["is_additional_resource"], "No document index found and not in Additional Resources"),
            F.when(F.size(ctx["hierarchy_path"]) < 2, "Shallow directory structure - may affect categorization"),
        )
    )
    return F.struct((F.size(issues) == 0).alias("is_valid"), issues.alias("issues"), warnings.alias("warnings"))


def folders_after(path: Column, marker: str) -> Column:
    """(policy, section): the two parts below the folder ``marker``; what is missing is ``Unknown`` or ``Root``."""
    parts = F.split(path, "/")
    at = F.array_position(parts, F.lit(marker)).cast("int")  # from 1, 0 if absent
    policy = F.when(at > 0, F.coalesce(F.get(parts, at), F.lit("Unknown"))).otherwise("Unknown")
    section = F.when((at > 0) & (at < F.size(parts)), F.coalesce(F.get(parts, at + 1), F.lit("Root"))).otherwise("Unknown")
    return F.struct(policy.alias("policy"), section.alias("section"))


def metadata(path: Column, ctx: Column, organisation: str, source_type: str = "policy_document", domain: str = "healthcare_policy") -> Column:
    """What is kept with a document for retrieval: file, hierarchy by level, classification, constants and tags."""
    level = [F.get(ctx["hierarchy_path"], F.lit(i)).alias(f"level_{i}") for i in range(4)]
    names = ["relative_path", "file_name", "policy_manual", "policy_acronym", "section", "subsection", "hierarchy_path", "document_index", "document_type", "is_additional_resource"]
    return F.struct(
        path.alias("file_path"),
        *[ctx[n].alias(n) for n in names],
        F.lit(source_type).alias("source_type"),
        F.lit(domain).alias("content_domain"),
        F.lit(organisation).alias("organization"),
        tags(ctx).alias("tags"),
        F.when(F.size(ctx["hierarchy_path"]) > 0, F.struct(*level)).alias("hierarchy"),
    )
