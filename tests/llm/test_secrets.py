import math
import random
import re
import string
import time
from collections import Counter

from tests.llm.cases import SCHEMA, no_docs, odd_docs, odd_rows

from tapeline.llm import secret_scan as S

KEY = "AKIA" + "ABCDEFGHIJ234567"
RANDOM = "q7Zt3LmX9vKp2RsW8dYb4NcH"


def base(text):
    flags = re.I | re.A
    out = [("assign", *m.span()) for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, flags) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


TEXTS = [
    "", f"x {KEY} y", "Password='hunter22' and api_key : abc", "password=token:\"abcdefg\"", "token==abcdefgh secret: 'a.b/c+d'", "0123456789abcdef" * 3, f"AKIAABC {KEY.lower()} z{KEY}",
    f"key {RANDOM} end", "ſecret=abcdefgh ToKen=abcdefgh", "a" * 23 + " " + "b" * 24, "日本 token=abcdef " + "f" * 30, f"{KEY}{'0' * 30}",
]


def test_base_spans_stay():
    for text in TEXTS:
        assert [s for s in S.find_secrets(text) if s[0] != "entropy"] == base(text)


def test_entropy_adds_random_strings_and_leaves_allowed_ones():
    found = S.find_secrets(f"see {RANDOM} here")
    assert found == [("entropy", 4, 4 + len(RANDOM))]
    for text in ("123e4567-e89b-12d3-a456-426614174000", "AbcdefExample0123456XyZwvutsr", "some_very_long_identifier_name", "2024-01-01-2024-01-02-2024-01", "path/to/some/long/file/name2024"):
        assert S.find_secrets(text) == []


def test_windows_by_incremental_counts():
    def entropy(s):
        return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())

    text = "aaaaaaaaaa" + RANDOM + "bbbbbbbbbbbbbbbbbbbb"
    covered = set()
    for i in range(len(text) - 19):
        if entropy(text[i : i + 20]) >= 3.75:
            covered |= set(range(i, i + 20))
    assert {i for a, b in S.hot_windows(text, 20, 3.75) for i in range(a, b)} == covered


def test_allowed_forms_take_linear_time():
    rng, keys = random.Random(4), string.ascii_letters + string.digits + "+/"
    began = time.perf_counter()
    for text in ("a" * 200 + "12345", "camelCase" * 20 + "_12345", "some/long/path/" * 20 + "20240101", "q" * 40 + "".join(rng.choices(keys, k=50_000))):
        S.find_secrets(text)
    assert time.perf_counter() - began < 5


def test_allowed_forms_are_the_same_strings():
    old = re.compile(r"(?:[A-Za-z]+[-_/]?)+[0-9]{0,4}")
    new = re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)*[-_/]?[0-9]{0,4}")
    assert S.ALLOWED_FORMS.pattern.endswith("|" + new.pattern)
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choices("aB-_/0", k=rng.randint(1, 9)))
        assert bool(old.fullmatch(text)) == bool(new.fullmatch(text))


def test_names_words_and_classes_do_not_hide_values():
    upper, short = "9F3A0C7E51B8D2466AE0F1937C5D8B24", "9f3a0c7e51b8d2466ae0f"
    for name in ("HTTP_AUTH=", "DB_SAMPLE_KEY=", "AWS_S3_KEY2=", "A=B="):
        for value in (RANDOM, upper, short):
            assert S.find_secrets(f"x {name}{value} y") == [("entropy", 2 + len(name), 2 + len(name) + len(value))]
    assert S.find_secrets(f"x {short} y") == [("entropy", 2, 2 + len(short))]
    [(_, lo, hi)] = S.find_secrets(f"x dir/zz_{upper} y")
    assert lo <= 9 and hi == 9 + len(upper)
    rng = random.Random(6)
    blob = "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=3000))
    found = S.find_secrets(blob[:1500] + "WwW" + blob[1500:])
    assert sum(b - a for kind, a, b in found if kind == "entropy") > 2900
    for text in ("id=123e4567-e89b-12d3-a456-426614174000", "abc-123e4567-e89b-12d3-a456-426614174000", "KEY=AbcdefExample0123456XyZwvutsr", "FILE=path/to/some/long/file/name2024"):
        assert S.find_secrets(text) == []


def test_operator(spark):
    got = S.scan(odd_docs(spark)).toPandas()
    assert len(got) == len(odd_rows()) and got.spans.map(len).sum() == 0
    assert S.scan(no_docs(spark)).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame([(1, f"a {KEY} b password=hunter22 c", "en", "s", 40), (2, "clean", None, None, 99), (None, None, None, None, None)], SCHEMA)
    rows = {r.doc_id: r for r in S.redact(docs).collect()}
    assert rows[1].text == "a [secret] b [secret] c" and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text == "clean" and rows[2].n_chars == 99 and rows[None].text is None


def test_very_many_spans_take_linear_time():
    rng = random.Random(8)
    keys = " ".join("".join(rng.choices(string.ascii_letters + string.digits, k=40)) for _ in range(50_000))
    hexes = " ".join(f"{rng.getrandbits(128):032x}" for _ in range(60_000))
    uuids = "-".join(f"{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}" for x in (f"{rng.getrandbits(128):032x}" for _ in range(55_000)))
    mixed = "/".join(f"{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}/{x}" for x in (f"{rng.getrandbits(128):032x}" for _ in range(28_000)))
    for text in (keys, hexes, uuids, mixed):
        began = time.process_time()
        S.find_secrets(text)
        assert len(text) > 1_900_000 and time.process_time() - began < 20


def plain_spans(text):
    """Entropy spans that no base span holds, each compared with all."""
    found = base(text)
    for run in S.RUN.finditer(text):
        for m in S.CANDIDATE.finditer(run.group()):
            for lo, hi in S.entropy_spans(m.group()):
                lo, hi = run.start() + m.start() + lo, run.start() + m.start() + hi
                if not any(a <= lo and hi <= b for _, a, b in found):
                    found.append(("entropy", lo, hi))
    return sorted(found, key=lambda f: (f[1], S.KINDS.index(f[0]), f[2]))


def test_spans_kept_are_those_that_no_base_span_holds():
    rng = random.Random(9)
    bits = [RANDOM, KEY, "token=", "secret: '", "0123456789abcdef" * 2, "9f3a0c7e51b8d2466ae0f1937c5d8b24", "123e4567-e89b-12d3-a456-426614174000", " ", "/", "-", "=", "abc", "q7Zt3LmX9vKp2RsW"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 9)))
        assert S.find_secrets(text) == plain_spans(text)


def windows_by_definition(text, width, bits):
    """Ranges of windows that pass, each window counted from nothing."""
    out = []
    for i in range(len(text) - width + 1):
        if sum(n * math.log2(n) for n in Counter(text[i : i + width]).values()) <= width * (math.log2(width) - bits) + 1e-9:
            if out and i <= out[-1][1]:
                out[-1] = (out[-1][0], i + width)
            else:
                out.append((i, i + width))
    return out


def test_every_class_by_definition():
    rng = random.Random(10)
    for _, _, width, bits in S.CLASSES:
        for _ in range(200):
            text = "".join(rng.choices(rng.choice(["ab01", string.hexdigits, string.ascii_letters + string.digits + "+/"]), k=rng.randint(width, 90)))
            assert S.hot_windows(text, width, bits) == windows_by_definition(text, width, bits)


def test_redaction_of_odd_and_no_rows(spark):
    rows = S.redact(odd_docs(spark)).collect()
    assert sorted(map(repr, ((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows))) == sorted(map(repr, odd_rows()))
    assert S.redact(no_docs(spark)).count() == 0
