import pytest

from fieldglass.llm import leakage

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen throw-in sixteen seventeen eighteen nineteen twenty apple berry cherry damson elder fig"
W = ITEM.split()


def but(at, *new, lo=2, hi=14):
    """The item's written words lo to hi, that of number `at` within them replaced."""
    return " ".join([*W[lo : lo + at], *new, *W[lo + at + 1 : hi]])


LEAKS = [
    but(1, "x"), but(10, "x"), but(1, "x", hi=15), but(11, "x", lo=0, hi=13), but(1), but(1, W[3], "x"),
    but(7, "x", lo=7, hi=22), but(7, "x-y", lo=7, hi=22), but(7, "x", lo=7, hi=19), but(7, "throw-out", lo=7, hi=19), but(7, "drop-in", lo=7, hi=19), but(7, W[9], "a-b-c"),
]
CLEAN = [but(1, "x", hi=13), but(7, "x", "y", lo=7, hi=22), but(7, W[9], "x", "y"), but(1, "x", hi=13) + " y " + W[14], but(0, hi=14), but(7, "x", lo=7, hi=18), " ".join(W[7:14] + ["x"] + W[15:18] + ["y"] + W[19:24])]


@pytest.mark.parametrize("side", [0, 1])
def test_altered_words_near_the_ends_and_hyphenated(spark, side):
    texts = [f"rain fell {t} over there" for t in (CLEAN if side else LEAKS)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id for r in leakage.leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")).collect()}
    assert got == (set() if side else set(range(len(LEAKS))))
