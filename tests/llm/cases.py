"""Documents that hold every awkward case, as rows and as a frame."""

import random

SEPARATORS = " \t\n\x0b\x0c\r"


def prose(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "and", "river", "stone", "house", "walks", "seven", "élan", "größe", "niño", "blue"]
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def edge_rows():
    """``(doc_id, text, source)``: nulls, empty and long texts, ties, copies, near copies."""
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    passage = prose(2, 60)
    rows = [
        (0, base, "src0"),
        (1, base, "src0"),
        (2, " ".join(near), "src1"),
        (3, None, "src1"),
        (4, "", "src2"),
        (5, " \n\t \x0b", None),
        (6, prose(3, 80) + "\n" + passage + "\n" + prose(4, 70), "src0"),
        (7, prose(5, 90) + " " + passage, "src0"),
        (7, prose(6, 40), "src3"),
        (8, "same row here for both of them", "src3"),
        (8, "same row here for both of them", "src3"),
        (None, prose(7, 50), "src1"),
        (None, base, None),
        (9, "one two", "src4"),
        (10, "ONE\ttwo", "src4"),
        (11, "a b c d e", "src4"),
        (12, "spam!! " * 300, "src2"),
        (13, prose(8, 30000), "src2"),
        (14, "日本語のテキスト 😀 \x00 ▁ literal ▁▁ mark  two", "src0"),
        (15, "x" * 3000, "src0"),
        (16, "=" * 250 + "\n" + "=" * 180, "src1"),
        (17, "odd### words$$$ all&&& over*** " * 20 + prose(9, 10), "src1"),
        (18, "Intro line\nReleased under the MIT License.", "src1"),
        (19, prose(1, 120).upper(), "src2"),
    ]
    rows += [(100 + i, prose(50 + i, 30 + 7 * (i % 13)), f"src{i % 3}") for i in range(60)]
    return rows


def edge_docs(spark, rows=None):
    """The rows with columns that clash with the operators' own, by name or but for case."""
    schema = (
        "doc_id long, text string, source string, TEXT string, row int, c0 int, size long,"
        " key long, tie double, part int, n_chars long"
    )
    full = [
        (d, t, s, "other", 1, 2, 3, 4, 0.5, 6, None if t is None else len(t))
        for d, t, s in (edge_rows() if rows is None else rows)
    ]
    return spark.createDataFrame(full, schema).repartition(3)


def words(text):
    out, held = [], ""
    for ch in (text or "") + " ":
        if ch in SEPARATORS:
            if held:
                out.append(held)
            held = ""
        else:
            held += ch
    return out


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def order_key(doc_id):
    """Null ids first."""
    return (doc_id is not None, doc_id or 0)
