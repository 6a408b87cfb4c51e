"""A table of edge cases: nulls in any column, empty and long texts, repeats, clashing column names."""

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, `key` string, own string,"
          " spans string, batch string, kind string, term string, _part string, curve string")
LONG = "word " * 60_000 + "end"


def edge_rows():
    def row(doc_id, text, lang="en", source="s"):
        return (doc_id, text, lang, source, None, *["x"] * 9)

    return [
        row(1, None), row(2, ""), row(3, "   \n\n "), row(4, LONG), row(5, "One short text, once."),
        row(6, "The same text twice over and over in the corpus."), row(6, "The same text twice over and over in the corpus."),
        row(7, "The same text twice over and over in the corpus."), row(None, "No id, mail a.b@c.de or +49 30 1234567."),
        row(8, "émile ünï 中文 😀 'll 12345   x", None, None), row(9, "!" * 3_000), row(10, "9" * 3_000), row(11, None, None, None),
    ]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def key(values):
    return sorted(values, key=repr)
