"""Rows that every operator has to take: NULLs, empty and long texts, ties, repeats, clashing column names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, key int, node string, shard string, n long"


def awkward(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, and columns named as the operators' own."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, "a b c d e f g h", "en", "x"), (2, "a b c d e f g h", "en", "x"), (3, "A B C D E F G H", None, None),
        (4, None, "en", "y"), (5, "", "de", "y"), (6, " \n\t ", None, "y"), (7, "one", "en", "x"), (8, long, "en", "z"),
        (9, long + " more", "en", "z"), (10, "é ü 漢字 😀\x85　x", "fr", ""), (10, "é ü 漢字 😀\x85　x", "fr", ""),
        (None, "no key here at all", "en", "x"), (2**60 + 1, "far key", None, None),
    ]
    return spark.createDataFrame([(*r, None, "s", 1, "n", "h", 5) for r in rows], SCHEMA)


#: Names that operators give to columns of their own, or gave once.
HELPERS = """key text row node rep rows order first bands root stays alone center reference parts linked bucket score top leader ref count
    _key _node _order _text _label _draw _cut _edge _whole _edge_taken _row _group _nth _block _rank _before _n _page
    draw cut edge whole taken repeats target source_size hashed size part place number""".split()


def renamed(df):
    """``df`` with a column of every helper's name that it hasn't."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"x{i}").alias(name) for i, name in enumerate(HELPERS) if name not in df.columns])
