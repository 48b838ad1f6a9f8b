"""Recall by kind of string, and ordinary strings that stay, for models trained on samples of their own."""

from __future__ import annotations

import random
import string

import pytest

from cueflow.llm import secret_scan as s

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
KINDS = {
    "hex of 20": (DIGITS + "abcdef", 20),
    "upper hex of 32": (DIGITS + "ABCDEF", 32),
    "lower and digits of 20": (LOWER + DIGITS, 20),
    "upper and digits of 20": (UPPER + DIGITS, 20),
    "base62 of 16": (LOWER + UPPER + DIGITS, 16),
    "base64 of 40": (LOWER + UPPER + DIGITS + "+/", 40),
    "base64url of 32": (LOWER + UPPER + DIGITS + "-_", 32),
    "letters of 32": (LOWER + UPPER, 32),
    "lower letters of 32": (LOWER, 32),
}
ORDINARY = """src/main/java/org/example/Foo2Bar
node_modules/react-dom/cjs2/index
https://www.example.com/de/6194?page=2&ref=x
com.example.project.service.UserAccountManager
/usr/local/lib/python3.13/site-packages/numpy/core
getElementsByClassName
application/vnd.openxmlformats-officedocument
ThisIsAVeryLongCamelCaseIdentifierName
some_snake_case_variable_name_2024
2024-01-15T10:30:00Z
antidisestablishmentarianism
org/apache/spark/sql/catalyst/expressions
+49-170-1234567-890
Content-Transfer-Encoding
kubernetes-ingress-controller-v2
en_US.UTF-8/locale/messages
MAX_CONNECTION_POOL_SIZE_EXCEEDED
HTTP_STATUS_INTERNAL_SERVER_ERROR
github/workflows/continuous-integration
test_get_user_by_id_returns_404
BenutzerKontoVerwaltungsDienst
requestAnimationFrameCallback
================================""".split("\n")


@pytest.fixture(scope="module")
def model():
    words = "river window garden planet silver market search letter customer thing other people because morning street between".split()
    n = s.SAMPLE_STRINGS
    return s.train([x for p in zip(s.random_strings(n), s.identifiers(words, n), strict=True) for x in zip(p, (1, 0), strict=True)])


def found(text: str, model) -> list:
    return [x for x in s.scan(text, model)[0] if x[2] == "markov"]


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_recall(model, kind):
    letters, n = KINDS[kind]
    rnd = random.Random(kind)
    strings = ["".join(rnd.choices(letters, k=n)) for _ in range(300)]
    assert sum(bool(s.scan(f"see {x} now", model)[0]) for x in strings) >= 0.9 * len(strings)


@pytest.mark.parametrize("part", [10, 14, 24])
def test_parts_between_dots(model, part):
    rnd = random.Random(part)
    strings = [".".join("".join(rnd.choices(LOWER + UPPER + DIGITS + "-_", k=part)) for _ in range(3)) for _ in range(200)]
    assert sum(bool(found(f"Bearer {x}, then", model)) for x in strings) >= 0.9 * len(strings)


def test_ordinary_strings_stay(model):
    assert [x for x in ORDINARY if found(f"see {x} now", model)] == []
