import sys
import unicodedata

from pyspark.sql import functions as F

from notelab.functions import text as tx


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).collect()[0]["y"]


def test_normalize_traps(spark):
    # plain substring replacement, not words: "drag x" -> "drantigene x"
    assert _one(spark, lambda c: tx.normalize_term(c, cased=False), "drag x") == "drantigene x"
    # only runs of spaces collapse; strip removes all outer white space
    assert _one(spark, lambda c: tx.normalize_term(c), "  a   b\t\tc \n") == "a b\t\tc"
    assert _one(spark, lambda c: tx.normalize_term(c), "Ag HBs-x") == "Antigene HBs x"


def test_fold_ascii(spark):
    assert _one(spark, tx.fold_ascii, "Œuvre cœur ßæ éèêë ÇÑ") == "OEuvre coeur ssae eeee CN"


def test_stopwords_and_specials(spark):
    f = lambda c: tx.normalize_term(c, cased=False, rm_stopwords=True, rm_special=True)
    assert _one(spark, f, "Dosage of the CRP (test)") == "dosage the crp"


def test_dice_identity(spark):
    df = spark.createDataFrame([("hemoglobine",)], "x string")
    g = tx.ngram_set(F.col("x"), 3)
    assert df.select(tx.dice(g, g).alias("d")).collect()[0]["d"] == 1.0


def test_fold_all_code_points(spark):
    """Every letter, number and symbol: what decomposes to ASCII and marks gives the ASCII."""
    def plain(ch):
        return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))

    table = {a for a, _ in tx.MULTI_CHAR_FOLDS + tx.SINGLE_CHAR_EXTRA}
    chars = [chr(i) for i in range(32, sys.maxunicode + 1) if unicodedata.category(chr(i))[0] in "LNS"]
    found = spark.createDataFrame([(c,) for c in chars] + [(None,), ("",)], "c string").select("c", tx.fold_ascii_all(F.col("c"))).collect()
    folded = dict(map(tuple, found))
    assert folded.pop(None) is None and folded.pop("") == ""
    latin = [c for c in chars if plain(c).isascii() and plain(c).isalpha() and c not in table]
    assert len(latin) > 1500
    assert {c: folded[c] for c in latin} == {c: plain(c) for c in latin}
    kept = "αάжйहिन한"  # other scripts stay as they are
    row = spark.createDataFrame([(kept + " Ꞗ ﬁn ① ǽ",)], "c string").select(tx.fold_ascii_all(F.col("c"))).first()
    assert row[0] == kept + " Ꞗ fin 1 ae"
