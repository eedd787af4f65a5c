import base64
import gzip
import hashlib
import re
import subprocess
import sys
import urllib.parse
import zlib
from pathlib import Path

import pytest

from fleetmill.llm import op5_secrets as s

SECRET = "password=hunter2hunter2"


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


@pytest.mark.parametrize("hidden", [
    b64(SECRET), b64(b64(SECRET)), b64(zlib.compress(SECRET.encode())), b64(gzip.compress(b64(SECRET).encode())), urllib.parse.quote(b64(SECRET)), "".join(f"\\u{ord(c):04x}" for c in SECRET),
    urllib.parse.quote("".join(f"%{ord(c):02X}" for c in SECRET)), "".join(f"&#{ord(c)};" for c in SECRET),
])
def test_decoded_layers_map_back(hidden):
    text = f"é 😀 before {hidden} after"
    base, more = s.scan(text)
    assert not base and any(text[a:b].rstrip("=") in hidden and hidden.startswith(text[a:b][:20]) and k.endswith("/assign") for a, b, k in more)


def test_escapes_map_character_by_character():
    text = "see token%3Dabcdefgh12 there"
    assert s.scan(text)[1] == [(4, 22, "url/assign")]
    assert s.scan("plain secret: abcdefgh %41 end") == ([(6, 22, "assign")], [])


def test_cycles_and_bombs_end():
    x = b64(b64(b64("no secret here at all")))
    assert s.scan(x * 3) is not None
    assert s.scan(b64(zlib.compress(b"z" * 5_000_000)))[1] == []


def kinds(text):
    return {k for _, _, k in s.scan(text)[1]}


def test_compressed_layers_are_read_to_their_end():
    for filler in (b"some words, " * 6_000_000, b"z" * 10_000_000, bytes(70_000_000)):
        assert kinds(b64(zlib.compress(filler + b" " + SECRET.encode() + b" ."))) == {"compressed/assign"}
    two = gzip.compress(b"first member, ") + gzip.compress(SECRET.encode())
    assert kinds(b64(two)) == {"compressed/assign"}
    assert kinds(b64(zlib.compress(b"\x00\xff\x01" * 50 + SECRET.encode() + b"\xfe\x02" * 50))) == {"compressed/assign"}


def test_nesting_has_no_depth():
    x = SECRET.encode()
    for _ in range(60):
        x = zlib.compress(x)
    assert kinds(b64(x)) == {"compressed/assign"}
    y = SECRET
    for k in range(12):
        y = b64(zlib.compress(y.encode()) if k % 2 else y)
    assert {k.split("/")[1] for k in kinds(y)} == {"assign"}


def test_short_compressed_runs():
    assert kinds("a " + b64(zlib.compress(b"0" * 32)) + " b") == {"compressed/hex"}
    for shift in range(3):
        glued = b64(b"q" * shift + zlib.compress(b"AKIA" + b"A" * 12))
        assert kinds(f"a {glued} b") == {"compressed/access"}


def test_nested_bombs_take_little_memory_and_are_reported():
    bomb = zlib.compress(zlib.compress(bytes(1 << 28), 9) * 8, 9)
    code = f"""
import resource, sys
from fleetmill.llm import op5_secrets as s
s.GRANTED = 1 << 20
found = s.scan(" ".join([sys.stdin.read()] * 100))[1]
assert len(found) == 100 and {{k for _, _, k in found}} == {{"compressed/unread"}}
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], input=b64(bomb), capture_output=True, text=True, cwd=Path(__file__).resolve().parents[2], timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 500


def by_hand(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    for rank, (kind, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)), 1):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_base_equals_plain_expressions(spark, odd_docs, no_docs):
    from llm_data import DATA

    from fleetmill.llm.common import read

    docs = read(spark, DATA, "documents").select("doc_id", "text")
    for r in s.scan_secrets(docs).join(docs, "doc_id").collect():
        spans = by_hand(r["text"])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for *_, k in spans) for x in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
        assert set(f"{k}:{a}:{b}" for a, b, k in spans) <= set(r["spans"].split(","))
    assert s.scan_secrets(odd_docs).count() == odd_docs.count() and s.scan_secrets(no_docs).count() == 0


def test_redaction(spark, odd_docs):
    got = s.redact_secrets(odd_docs)
    assert got.dtypes == odd_docs.dtypes and got.count() == odd_docs.count()
    assert not s.scan(s.scan(f"a {SECRET} b {b64(SECRET)}") and [r["text"] for r in got.collect() if r["text"] and "without" in r["text"]][0])[0]


NOISE = "".join(f"line {i * i} of a longer letter, {hashlib.md5(str(i).encode()).hexdigest()[:9]}; " for i in range(12))


@pytest.mark.parametrize("payload", [f"{NOISE[:40]} {SECRET} {NOISE}".encode(), zlib.compress(f"{NOISE} {SECRET} {NOISE}".encode()), gzip.compress(f"{NOISE} {SECRET}".encode())])
@pytest.mark.parametrize("line_break", ["\n", "\r\n", "\n    "])
def test_wrapped_base64_is_joined(payload, line_break):
    whole = b64(payload)
    wrapped = line_break.join(whole[i : i + 76] for i in range(0, len(whole), 76))
    for before, after in (("see\n\n", "\n\nend"), ("-----BEGIN X-----\n", "\n-----END X-----"), ("a word\n", "\nand more words")):
        text = before + wrapped + after
        hits = [(a, b) for a, b, k in s.scan(text)[1] if k.endswith("/assign")]
        at = len(before)
        assert any(a < at + 76 < b for a, b in hits), text


@pytest.mark.parametrize("packed", [SECRET.encode(), zlib.compress(SECRET.encode()), b64(SECRET).encode()])
@pytest.mark.parametrize("glue", ["com/{}", "key_{}", "x-{}", "a/bc-d_{}", "{}/tail", "ab{}-x_y", "x{}", "https://ex.org/a-b/{}/c"])
def test_glued_base64_is_found(packed, glue):
    hidden = b64(packed).rstrip("=")
    text = "before " + glue.format(hidden) + " after"
    at = text.index(hidden)
    assert any(k.endswith("/assign") and a <= at + 8 and b >= at + len(hidden) - 4 for a, b, k in s.scan(text)[1])


def test_long_runs_take_linear_time():
    assert s.scan("x" * 200_000 + " " + "a/b-" * 50_000 + "\n" + "word\n" * 20_000) == ([], [])
