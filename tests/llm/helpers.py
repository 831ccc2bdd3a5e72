"""Small corpora with the awkward cases every operator must bear."""

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, slot STRING"


def corpus(spark, texts, source=lambda i: f"src{i % 3}", first=0):
    """``slot`` is an extra column whose name some operators use for themselves."""
    rows = [(first + i, t, "en" if i % 2 else None, source(i), len(t or ""), "x")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)
