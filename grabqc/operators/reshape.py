"""Wide field template to long results.

Everything known about one reading (value, replicate value, qualifier, comment, submitted
grades) sits in one template row, so melting and attaching the metadata is a per-row step with
no shuffle.
"""

import re

from pyspark.sql import functions as F

# Column-name endings of the template, compared without regard to case.
RESULT_SUFFIXES = ("_r", "_RESULTS")
METADATA_SUFFIXES = {
    "Res_comment": ("_cmnt", "_COMMENTS"),
    "RsltQual": ("_qual",),
    "OG_ACC": ("_ACC",),
    "OG_PREC": ("_PREC",),
    "OG_DQL": ("_DQL",),
}

VISIT_COLUMNS = ["LASAR_ID", "samplers", "DateTime", "SampleDepth", "SampleDepthUnit", "SampleMedium",
                 "SampleColMthd", "SampleColEquip", "SampleColEquipID", "SampleColEquipCmnt",
                 "DEQ_Comment", "Org_Comment"]
ROW_KEY = ["subid", "row_ID"]


def strip_suffix(name, suffixes):
    """The name without its ending, or None when it has none of the endings."""
    for suffix in suffixes:
        if name.lower().endswith(suffix.lower()) and len(name) > len(suffix):
            return name[:-len(suffix)]
    return None


def classify_result_column(name, known=None):
    """(characteristic, 'sample' or 'dup') read from a result column's name.

    ``X_r`` is a primary value of X and ``Xd_r`` a replicate of X. With a list of known
    characteristics the reading that is listed wins, and a column that fits both ways raises.
    """
    code = strip_suffix(name, RESULT_SUFFIXES)
    if code is None:
        return None
    is_short = re.search(r"d_r$", name, re.IGNORECASE) is not None and len(code) > 1
    if not known:
        return (code[:-1], "dup") if is_short else (code, "sample")
    as_primary, as_replicate = code in known, is_short and code[:-1] in known
    if as_primary and as_replicate:
        raise ValueError(f"column {name!r} is a primary of {code!r} and a replicate of {code[:-1]!r}")
    if as_replicate or (is_short and not as_primary):
        return code[:-1], "dup"
    return code, "sample"


def result_columns(columns, known=None):
    """[(column, characteristic, class)] for every result column of the template."""
    found = [(c, classify_result_column(c, known)) for c in columns]
    return [(c, *kind) for c, kind in found if kind]


def metadata_columns(columns, family):
    """[(column, characteristic)] of one metadata family; empty when the template has none."""
    found = [(c, strip_suffix(c, METADATA_SUFFIXES[family])) for c in columns]
    return [(c, code) for c, code in found if code]


def _name(column):
    return "`" + column.replace("`", "``") + "`"


def _quote(text):
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text(column):
    """SQL for a cell as text, NULL when blank."""
    cell = f"cast({_name(column)} AS string)"
    return f"if(trim({cell}) <> '', {cell}, NULL)"


def _number(column):
    return f"try_cast({_name(column)} AS double)"


def _unfold(cells, fields, needed):
    """SQL making one row per cell that holds a value.

    Empty cells are dropped inside the array, before any row is made. That also keeps the cells
    out of the generated code, which hundreds of columns would grow too large to compile.
    """
    if not cells:
        return F.expr(f"inline(cast(array() AS array<struct<{', '.join(f'{n}: {t}' for n, t in fields.items())}>>))")
    return F.expr(f"inline(filter(array({', '.join(cells)}), cell -> cell.{needed} IS NOT NULL))")


def _metadata(columns, family):
    """SQL by characteristic for one family's value."""
    cells = {}
    for column, code in metadata_columns(columns, family):
        cells.setdefault(code, []).append(_text(column))
    return {code: f"coalesce({', '.join(texts)})" for code, texts in cells.items()}


def melt_results(template, known=None):
    """One row per template row and result column holding a value, with its metadata.

    A replicate gets the metadata of its primary, as both share the characteristic code. The
    cells are written as SQL text: a template has hundreds of columns, and one expression is
    quicker to hand over than one object per cell.
    """
    columns = template.columns
    metadata = {family: _metadata(columns, family) for family in METADATA_SUFFIXES}
    cells = [
        f"named_struct('Char', {_quote(column)}, 'CharIDText', {_quote(code)}, 'sample_type', '{kind}', "
        f"'Result', {_number(column)}, "
        + ", ".join(f"'{family}', {of.get(code, 'cast(NULL AS string)')}" for family, of in metadata.items()) + ")"
        for column, code, kind in result_columns(columns, known)]
    fields = {"Char": "string", "CharIDText": "string", "sample_type": "string", "Result": "double",
              **{family: "string" for family in METADATA_SUFFIXES}}
    visit = [F.col(c) if c in columns else F.lit(None).cast("string").alias(c) for c in VISIT_COLUMNS]
    return template.select(*ROW_KEY, *visit, _unfold(cells, fields, "Result"))


def unreadable_results(template, known=None):
    """One row per result cell that holds a text and no number, which melting leaves out."""
    cells = [
        f"named_struct('Char', {_quote(column)}, 'CharIDText', {_quote(code)}, 'text', if({_number(column)} IS NULL, {_text(column)}, NULL))"
        for column, code, _ in result_columns(template.columns, known)]
    return template.select(*ROW_KEY, _unfold(cells, {"Char": "string", "CharIDText": "string", "text": "string"}, "text"))


def melt_metadata(template, family):
    """One row per non-missing cell of a metadata family; no rows when the family is absent."""
    cells = [f"named_struct('column', {_quote(column)}, 'CharIDText', {_quote(code)}, '{family}', {_text(column)})"
             for column, code in metadata_columns(template.columns, family)]
    fields = {"column": "string", "CharIDText": "string", family: "string"}
    return template.select(*ROW_KEY, _unfold(cells, fields, family))


def melt_all_metadata(template):
    """One row per non-missing cell of any metadata family, with the family's name; one pass over the rows."""
    cells = [f"named_struct('family', '{family}', 'column', {_quote(column)}, 'CharIDText', {_quote(code)}, 'value', {_text(column)})"
             for family in METADATA_SUFFIXES for column, code in metadata_columns(template.columns, family)]
    fields = {n: "string" for n in ("family", "column", "CharIDText", "value")}
    return template.select(*ROW_KEY, _unfold(cells, fields, "value"))


def visit_comments(template):
    """Template rows holding a comment of either organisation."""
    return (template.select(*ROW_KEY, "DEQ_Comment", "Org_Comment")
            .where(F.col("Org_Comment").isNotNull() | F.col("DEQ_Comment").isNotNull()))


def orphan_metadata(template, known=None):
    """Metadata cells with no result of their characteristic in the same template row."""
    results = {}
    for column, code, _ in result_columns(template.columns, known):
        results.setdefault(code, []).append(_number(column))
    cells = [
        f"named_struct('family', '{family}', 'column', {_quote(column)}, 'CharIDText', {_quote(code)}, 'value', "
        f"if(coalesce({', '.join(results.get(code, []) + ['NULL'])}) IS NULL, {_text(column)}, NULL))"
        for family in METADATA_SUFFIXES for column, code in metadata_columns(template.columns, family)]
    fields = {n: "string" for n in ("family", "column", "CharIDText", "value")}
    return template.select(*ROW_KEY, _unfold(cells, fields, "value"))
