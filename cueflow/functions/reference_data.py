"""Fixed dimensions: books with their canon and chapters, and recogniser languages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Chapters of each book.
OT = {
    "GEN": 50, "EXO": 40, "LEV": 27, "NUM": 36, "DEU": 34, "JOS": 24, "JDG": 21, "RUT": 4, "1SA": 31, "2SA": 24, "1KI": 22, "2KI": 25, "1CH": 29,
    "2CH": 36, "EZR": 10, "NEH": 13, "EST": 10, "JOB": 42, "PSA": 150, "PRO": 31, "ECC": 12, "SNG": 8, "ISA": 66, "JER": 52, "LAM": 5, "EZK": 48,
    "DAN": 12, "HOS": 14, "JOL": 3, "AMO": 9, "OBA": 1, "JON": 4, "MIC": 7, "NAM": 3, "HAB": 3, "ZEP": 3, "HAG": 2, "ZEC": 14, "MAL": 4,
}
NT = {
    "MAT": 28, "MRK": 16, "LUK": 24, "JHN": 21, "ACT": 28, "ROM": 16, "1CO": 16, "2CO": 13, "GAL": 6, "EPH": 6, "PHP": 4, "COL": 4, "1TH": 5, "2TH": 3,
    "1TI": 6, "2TI": 4, "TIT": 3, "PHM": 1, "HEB": 13, "JAS": 5, "1PE": 5, "2PE": 3, "1JN": 5, "2JN": 1, "3JN": 1, "JUD": 1, "REV": 22,
}

# ISO 639-3 codes and the recogniser's codes; None asks for detection.
RECOGNISER = {
    "nld": "nl", "pol": "pl", "ell": "el", "hun": "hu", "fra": "fr", "rus": "ru", "kor": "ko", "por": "pt", "swe": "sv", "pes": "fa", "arb": "ar", "heb": "he", "ind": "id", "bul": "bg",
    "vie": "vi", "bos": "bs", "amh": "am", "kaz": "kk", "som": "so", "sun": "su", "ydd": "yi", "hau": "ha", "ibo": None, "kan": "kn", "yor": "yo", "lin": "ln", "zsm": "ms", "eng": "en",
    "spa": "es", "cmn": "zh", "tur": "tr", "ron": "ro", "urd": "ur", "mar": "mr", "npi": "ne", "tat": "tt", "yue": "zh", "hin": "hi", "ben": "bn", "uzn": "uz",
}


def books(spark: SparkSession) -> DataFrame:
    """book, canon, n_chapters: 66 rows."""
    rows = [(b, c, n) for c, d in (("OT", OT), ("NT", NT)) for b, n in d.items()]
    return spark.createDataFrame(rows, "book string, canon string, n_chapters int")


def recogniser_languages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*RECOGNISER.items()], "iso string, asr_lang string")


def canon_of(book: str, otherwise: str | None = "UNKNOWN") -> Column:
    """Canon of a book."""
    return F.when(F.col(book).isin(*NT), "NT").when(F.col(book).isin(*OT), "OT").otherwise(F.lit(otherwise))


def testaments(choice: str | None) -> list[str]:
    """Canons of a choice: nt, ot, both or none."""
    return {"nt": ["NT"], "ot": ["OT"]}.get((choice or "both").lower(), ["NT", "OT"])
