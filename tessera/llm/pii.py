"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in a text: at-signs, digits, plus signs, schemes and identifier cues. A deterministic parser at each anchor expands to the boundaries of an email, an address, a card or phone number, and validates it. Spans of one kind don't overlap; a failed match isn't retried inside itself. Beside the four base kinds the method finds account numbers (IBAN, checked by its remainder), secrets and addresses with sign-in data, each behind its cue.

Defined cases: a null or empty text has no spans; a null doc_id stays null; repeated documents are rows of their own; an empty table gives an empty result. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import keyed_texts
from tessera.llm.registry import query

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "secret", "login")

# The characters of an email's local part, and the shapes behind each anchor.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[:#\s]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_SECRET = re.compile(r"[\s\"']{0,2}[=:][\s\"']{0,3}([A-Za-z0-9+/_-]{16,}={0,2})")
_LOGIN = re.compile(r"://[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")
_CUES = {"iban": "account", "token": "secret", "secret": "secret", "password": "secret", "api_key": "secret", "apikey": "secret"}


def luhn(digits: str) -> bool:
    """Whether the digits pass the check of card numbers."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """Whether the remainder of an account number by 97 is 1."""
    raw = text.replace(" ", "")
    return 15 <= len(raw) <= 34 and int("".join(str(int(c, 36)) for c in raw[4:] + raw[:4])) % 97 == 1


def anchors():
    """The automaton; a word's value is its kind of anchor."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue, kind in _CUES.items():
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def spans(text: str | None, automaton) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of every span, in that order."""
    if not text:
        return []
    out = []
    email_end = ip_end = card_end = phone_end = account_end = secret_end = login_end = 0
    for last, (kind, size) in automaton.iter(text):
        p = last - size + 1
        if kind == "digit":
            if p >= card_end and (m := _CARD.match(text, p)):
                card_end = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((p, 2, card_end))
            if p >= ip_end and not (p and text[p - 1] in "0123456789") and (m := _IP.match(text, p)):
                ip_end = m.end()
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                    out.append((p, 1, ip_end))
        elif kind == "at":
            if p >= email_end and (m := _DOMAIN.match(text, p)):
                i = p
                while i > email_end and text[i - 1] in _LOCAL:
                    i -= 1
                if i < p:
                    email_end = m.end()
                    out.append((i, 0, email_end))
        elif kind == "plus":
            if p >= phone_end and (m := _PHONE.match(text, p)):
                phone_end = m.end()
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((p, 3, phone_end))
        elif kind == "account":
            if p >= account_end and (m := _IBAN.match(text, last + 1)) and iban_valid(m[1]):
                account_end = m.end()
                out.append((m.start(1), 4, account_end))
        elif kind == "secret":
            if p >= secret_end and (m := _SECRET.match(text, last + 1)):
                secret_end = m.end()
                out.append((m.start(1), 5, secret_end))
        elif p >= login_end and (m := _LOGIN.match(text, p)):
            i = p
            while i > login_end and text[i - 1].isascii() and text[i - 1].isalpha():
                i -= 1
            login_end = m.end()
            out.append((i, 6, login_end))
    out.sort()
    return out


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base kinds, base_sha256 and spans of every document."""

    def run(batches):
        automaton = anchors()
        for batch in batches:
            rows = [spans(t.as_py(), automaton) for t in batch.column(1)]
            base = [",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in r if k < 4) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([sum(k == j for _, k, _ in r) for r in rows], pa.int64()) for j in range(4)),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in r) for r in rows], pa.string()),
                ],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return keyed_texts(docs).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str | None, automaton) -> str | None:
    """The text with each span replaced by its kind in angle brackets. Of spans that overlap the one that starts first stays, and what it leaves of another is masked too."""
    found = spans(text, automaton)
    if not found:
        return text
    out, at = [], 0
    for a, k, b in found:
        if b <= at:
            continue
        out.append(text[at : max(a, at)])
        out.append(f"<{KINDS[k].upper()}>")
        at = b
    return "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """The documents with all their columns and masked texts; n_chars, where there is one, follows the text."""
    @F.pandas_udf("string")
    def mask(batches: pd.Series) -> pd.Series:
        automaton = anchors()
        return pd.Series([masked(t, automaton) for t in batches], dtype=object)

    out = docs.withColumn("text", mask(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
