"""Fingerprints of organisation names."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What company names end with, what municipal names begin with, and simplifications, all in this order.
ENDINGS = ['בע"מ', "בע״מ", "בעמ", "בע'מ", '(חל"צ)', "(חל״צ)", "חברה לתועלת הציבור", 'בע"מ.', "אינק.", "לימיטד", 'בע"מ"', "בע,מ", 'עב"מ', 'בע"ם', '(ע"ר)', ')ע"ר(', "(ע''ר)", 'בע"מ (חל"צ)', "(ער)", "{ער}", "}ער{", "(חלצ)", "ישראל", "."]
TITLES = ["עירית", "עיריית", "מ.א.", "מ.מ.", "מ.א", "מ.מ", "מ. מ.", "מ. א.", "מועצה איזורית", "מועצה אזורית", "מועצה מקומית", 'מוא"ז', "עמותת", "קבוצת"]
SIMPLER = [("*", ""), ("%", ""), (" אל-", " "), ('"', ""), ("״", ""), ("~", ""), ("'", ""), ("-", " "), ("וו", "ו"), ("יי", "י"), (",", ""), (". ", " "), (".", " "), (")", " "), ("(", " "), ("/", " "), ("\\", " "), ("­", " "), ("המועצה הדתית", "מ.ד."), ("מועצה דתית", "מ.ד.")]
EMPTY = "<empty>"


def _begun(word: str) -> str:
    """Pattern of any beginning of a word, its first character at least."""
    out = ""
    for c in reversed(word):
        out = re.escape(c) + (f"(?:{out})?" if out else "")
    return out


_CUTS = [re.compile(rf" {_begun(w)}\Z", re.S) for w in ENDINGS]
_HEADS = [re.compile(rf"\A{re.escape(t)} ") for t in TITLES]
_NUMBER, _LATIN = re.compile(r"\d\d+"), re.compile("[a-zA-Z]+")


def _without_endings(text: str) -> str:
    before = None
    while text != before:
        before = text
        for cut in _CUTS:
            text = cut.sub("", text, count=1).strip()
    return text


def fingerprint(name: str | None) -> str:
    """What different spellings of an organisation's name share: sorted words without company endings, municipal titles,
    marks and latin letters; long numbers only count for short names."""
    if name is None:
        return EMPTY
    stages = [name.strip().lower()]
    stages.append(_without_endings(stages[-1]))
    for head in _HEADS:
        stages.append(head.sub("", stages[-1]))
    plain = stages[-1]
    for old, new in SIMPLER:
        plain = plain.replace(old, new)
    stages += [plain, _NUMBER.sub("", plain)]
    stages.append(_LATIN.sub("", stages[-1]))
    text = next((s.strip() for s in reversed(stages) if s.strip()), "")
    numbers = sorted(_NUMBER.findall(plain))
    if numbers and len(text) < 20 and stages[-1].strip():  # else the text still has its numbers
        text = " ".join([text, *numbers])
    return " ".join(sorted(text[:30].split())) or EMPTY


@F.pandas_udf(T.StringType())
def fingerprint_udf(names: pd.Series) -> pd.Series:
    codes, values = pd.factorize(names, use_na_sentinel=False)  # each different name is worked out once a batch
    made = pd.Series([fingerprint(None if pd.isna(v) else v) for v in values], dtype=object)
    return made.take(codes).reset_index(drop=True)


@F.pandas_udf(T.StringType())
def slug_udf(texts: pd.Series) -> pd.Series:
    """Latin letters and digits joined by hyphens, 32 characters at most."""
    import unicodedata

    def slug(t):
        if t is None:
            return None
        plain = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()
        return re.sub("[^a-z0-9]+", "-", plain).strip("-")[:32].strip("-")

    return texts.map(slug, na_action="ignore").astype(object)


@F.pandas_udf(T.StringType())
def unescape_udf(texts: pd.Series) -> pd.Series:
    import html

    return texts.map(html.unescape, na_action="ignore").astype(object)
