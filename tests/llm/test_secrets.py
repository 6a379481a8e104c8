"""Secret spans: base patterns against another formulation, assignments, defined cases."""

import hashlib
import re
import time

import pytest
from helpers import docs_frame, with_odd_columns

from tideframe.llm import secrets

KEY = "AKIA" + "Q" * 12
HEX = "0123456789abcdef" * 2


def brute(text):
    """The base patterns as stated, without shortcuts."""
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        spans += [(m.start(), 0, m.end())] * (len(m[2]) >= 8)
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)]


TEXTS = [
    f'é token = "{HEX}" and {KEY}', f"x{HEX}y AKIASHORT {KEY}AKIA{KEY}", "PassWord:short", "api_key=abcdefgh, apikey: 'ijklmnop=='", "secret = secret = abcdefgh",
    f"token=token=abcdefghij {HEX}{HEX}", "no secrets", "", None, "\n".join(["password = " + HEX] * 3), "passwd   :   A1b2C3d4", f"{HEX}AKIA0123456789AB",
]


def test_long_line_is_read_once():
    """A megabyte of name characters on one line, and names of any length and with digits before them."""
    start = time.perf_counter()
    long = "x = 1; " + "aB3d" * 250_000
    assert [s for s in secrets.find_spans(long) if s[0] > 2] == []
    assert time.perf_counter() - start < 2
    value = "q9Zr7Lp2Xw4Kt8Vb"
    for name in ("dbPassword", "9db_password", '"' + "n" * 200 + '_password"'):
        text = f"{name} := '{value}'"
        assert (3, text.index(value), text.index(value) + 16) in secrets.find_spans(text)


def test_base_spans(spark):
    docs = with_odd_columns(docs_frame(spark, [*TEXTS, TEXTS[0]]), "row", "secrets", "spans")
    for r in secrets.secret_digests(secrets.scan_documents(docs)).collect():
        base = brute((TEXTS + TEXTS[:1])[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in secrets.KINDS[:3]] == base
        assert len(spans) == len(base) + r.n_added
    assert secrets.scan_documents(docs.limit(0)).count() == 0


LITERAL = "qX7mK2vT9pLw4RzB"


@pytest.mark.parametrize(
    "text,found",
    [
        (f'db_pass = "{LITERAL}"', ["literal"]),
        (f"dbPassword: '{LITERAL}'", ["literal"]),
        (f'{{"client_secret": "{LITERAL}"}}', ["literal"]),
        (f'K = "{LITERAL}"\nAUTH_TOKEN = K', ["constant"]),
        (f'a = "qX7mK2vT"\nsigning_key = a + "9pLw4RzB"', ["constant", "literal"]),
        (f'headers["Authorization-Token"] := "{LITERAL}"', ["literal"]),
        (f"private_key => {LITERAL}", ["literal"]),
        (f'colour = "{LITERAL}"', []),
        ('db_password = "changeme123"', []),
        ("password = ${DB_PASSWORD_FILE}", []),
        (f'AUTH_TOKEN = K\nK = "{LITERAL}"', []),
        ('auth_token = "aaaaaaaaaaaa"', []),
        ("a == b: c", []),
    ],
)
def test_assignments(text, found):
    spans = sorted(secrets.literal_spans(text))
    assert sorted(kind for kind, _, _ in spans) == found
    assert all(LITERAL[:8] in text[a:b] or "9pLw4RzB" in text[a:b] for _, a, b in spans)


def test_names_and_values():
    assert secrets.name_score("DB_PASSWORD") == secrets.name_score("dbPassword") == 3
    assert secrets.name_score("apiKey") == 2 and secrets.name_score("tokenizer") == 0
    assert secrets.value_score("short") == 0 and secrets.value_score(LITERAL) == 4
