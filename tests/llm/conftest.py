from __future__ import annotations

import pytest

# Names that operators use, or used, for columns of their own.
CLASHES = ("id", "_id", "_key", "_found", "_dropped", "_row", "_score", "text_key", "found", "row", "dropped", "label", "rank", "tree")
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of texts, or of (id, text, source); extra columns have names that operators use themselves."""

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, source = row if isinstance(row, tuple) else (i, row, "s")
            full.append((doc_id, text, "en", source, len(text or ""), "x", 1, *("x" * len(CLASHES))))
        return spark.createDataFrame(full, DOCUMENT + ", size string, class int, " + ", ".join(f"{c} string" for c in CLASHES))

    return make
