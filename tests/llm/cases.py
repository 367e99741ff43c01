"""Documents with everything that can be odd about them."""

from __future__ import annotations

# Columns that operators use as working names.
EXTRA = ["size", "block", "digest", "node", "label", "target", "found", "row_key", "held_out", "bucket"]
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          + ", ".join(f"{name} string" for name in EXTRA))

PROSE = ("the river runs past the old mill and the children play near the water until evening comes and "
         "their parents call them home for supper while the lamps are lit along the quiet street")
FRENCH = ("la rivière coule devant le vieux moulin et les enfants jouent près de l'eau jusqu'au soir quand "
          "leurs parents les appellent à la maison pour le souper et que les lampes s'allument dans la rue")
SHARED = "This very line stands in several documents."


def rows() -> list[tuple]:
    texts: list[tuple] = [
        (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, PROSE.upper(), "en", "b"),  # copies, one in capitals
        (4, PROSE + " again", "en", None), (5, FRENCH, "fr", "b"), (6, FRENCH + " encore", "fr", ""),
        (7, None, "en", "a"), (8, "", None, "a"), (9, " \t\n ", "en", None),
        (10, SHARED + "\nown line of ten", "en", "a"), (11, "x\n  " + SHARED.upper() + " \t\ny", "en", "b"),
        (12, SHARED + "\n" + SHARED, "en", "a"), (13, "12345 --- 678", "en", "c"),
        (14, "word", "en", "c"), (15, "Word", "en", "c"), (15, "Word", "en", "c"),  # a repeated row
        (None, PROSE, "en", "a"), (None, None, None, None),  # no id
        (16, "été \x1c\x85 \U0001f600 İSTANBUL ΣΑΣ é <|endoftext|>tail ''s don't", "fr", "d"),
        (17, (PROSE + " " + FRENCH + "\n") * 400, "en", "d"),  # very long
        (18, "z" * 50_000, "en", "d"),
        (19, "Write to jo.ann.7@mail.example.com or +1 (555) 010-4477, card 4111 1111 1111 1111.", "en", "e"),
    ]
    return [(doc_id, text, lang, source, None if text is None else len(text), *EXTRA)
            for doc_id, text, lang, source in texts]


def odd_docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
