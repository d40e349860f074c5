"""Tables with everything that may be wrong with one."""

#: Names that operators use inside; a table may have columns of the same names.
CLASHING = (
    "n", "start", "segment", "anchor", "class", "bucket", "component", "component_id", "kept",
    "length", "rank", "sequence_id", "offset", "blob", "findings", "seen", "lang_pred", "score",
    "rejected", "text_hash", "windows", "changes", "shard", "block", "kept_id", "hit_id", "_salt",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{name}` string" for name in CLASHING
)


def build(spark, rows):
    """A documents table from ``(doc_id, text, lang)`` with columns of clashing names."""
    filler = (None, None, *("x" for _ in CLASHING))
    return spark.createDataFrame([(*row, *filler) for row in rows], SCHEMA)
