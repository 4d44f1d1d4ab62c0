"""String columns: identifiers, TeX, templates, prompts. Catalyst expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievemill.functions import fixed


def partition_first(text: Column, delimiter: str) -> Column:
    """struct(head, tail) at the first delimiter; tail is empty where there is none."""
    at = F.instr(text, delimiter)
    return F.struct(F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text).alias("head"), F.when(at > 0, F.substring(text, at + len(delimiter), F.length(text))).otherwise(F.lit("")).alias("tail"))


def squeeze(text: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_paper_id(text: Column) -> Column:
    """Preprint id without its URL, .pdf, closing slash and version."""
    bare = F.regexp_replace(F.trim(text), fixed.PAPER_URL, "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"\.pdf\z", ""), r"/\z", ""), fixed.PAPER_VERSION, "")


def clean_tex(text: Column, limit: int = 12_000) -> Column:
    """Prose of a TeX fragment: comments, citations and footnotes, commands and braces go."""
    for pattern in fixed.TEX_CLEANING:
        text = F.regexp_replace(text, pattern, "")
    return F.substring(squeeze(text), 1, limit)


def sanitize_filename(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9_.-]", "_")


def padded_id(number: Column, width: int, prefix: str = "") -> Column:
    """Zero-padded; longer numbers stay whole."""
    return F.format_string(f"{prefix}%0{width}d", number.cast("long"))


def composite_id(*parts: Column, separator: str = ":") -> Column:
    return F.concat_ws(separator, *parts)


def hash_id(text: Column, prefix: str, length: int = 20) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, length))


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of part."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def render(template: Column, values: dict[str, Column], strict: bool = False) -> Column:
    """{{ name }} gives way to values. strict: each marker must occur exactly once, else the query fails."""
    out = template
    for name, value in values.items():
        marker = f"{{{{ {name} }}}}"
        filled = F.replace(out, F.lit(marker), value)
        out = F.when(occurrences(template, marker) == 1, filled).otherwise(F.raise_error(F.lit(f"marker {marker} must occur once"))) if strict else filled
    return out


def option_list(options: Column) -> Column:
    """array<struct(letter, text)> as lines 'A. text'."""
    return F.array_join(F.transform(options, lambda o: F.concat(o["letter"], F.lit(". "), o["text"])), "\n")


def choices_text(choices: Column) -> Column:
    """array<string> as a block headed Choices:, empty without choices."""
    return F.when(F.coalesce(F.size(choices), F.lit(0)) > 0, F.concat(F.lit("Choices:\n"), F.array_join(F.transform(choices, lambda x: F.trim(x)), "\n"))).otherwise(F.lit(""))


def bullet_list(groups: Column) -> Column:
    """array<array<string>> flattened to lines '- item'."""
    return F.array_join(F.transform(F.flatten(groups), lambda x: F.concat(F.lit("- "), x)), "\n")


def prompt(template: str, **parts: tuple[Column, int]) -> Column:
    """template with {name} filled from (column, longest length)."""
    out = F.lit(template)
    for name, (value, limit) in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.substring(F.coalesce(value, F.lit("")), 1, limit))
    return out


def encode_payload(text: Column, how: str = "base64") -> Column:
    raw = F.encode(text, "UTF-8")
    return F.base64(raw) if how == "base64" else F.lower(F.hex(raw))


def presence_flags(text: Column, patterns: dict[str, str]) -> list[Column]:
    """A boolean column for each named pattern, letters in either case."""
    return [F.coalesce(text.rlike("(?i)" + p), F.lit(False)).alias(name) for name, p in patterns.items()]


def variant_context(text: Column) -> Column:
    """struct(chromosome, position, gene) of a question about a variant; null where nothing is found."""
    some = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    without = lambda names, stop: F.filter(names, lambda g: ~g.isin(*stop))
    bracketed = without(F.regexp_extract_all(text, F.lit(fixed.GENE_BEFORE_BRACKET), 1), fixed.NOT_BEFORE_BRACKET)
    cued = F.regexp_extract_all(text, F.lit(fixed.GENE_AFTER_CUE), 1)
    genes = without(F.when(F.size(bracketed) > 0, bracketed).otherwise(cued), fixed.NOT_A_GENE)
    return F.struct(some(fixed.CHROMOSOME).alias("chromosome"), some(fixed.POSITION).alias("position"), F.try_element_at(genes, F.lit(1)).alias("gene"))


def figure_bodies(tex: Column) -> Column:
    """array<string>: bodies of the figure environments, in order."""
    return F.regexp_extract_all(tex, F.lit(fixed.TEX_FIGURE), 1)


def figure_labels(body: Column) -> Column:
    return F.filter(F.regexp_extract_all(body, F.lit(fixed.TEX_LABEL), 1), lambda x: F.lower(x).contains("fig"))


def figure_images(body: Column) -> Column:
    """Distinct image arguments in first order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(fixed.TEX_IMAGE), 1), lambda x: F.trim(x)))


def canonical_json(value: Column) -> Column:
    """Compact JSON of a struct whose fields are named in order; an identity inside the engine."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def content_hash(*columns: Column) -> Column:
    """SHA-256 of the columns' canonical JSON; nulls count and differ from empty strings."""
    return F.sha2(canonical_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)])), 256)
