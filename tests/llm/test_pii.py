import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from skytally.llm import pii


def brute(text):
    found = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[1])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.b@c-1205+ ()%_é😀4539\n", max_size=60))
def test_base_kinds_against_patterns(text):
    assert [s for s in pii.spans(text) if s[1] in pii.BASE_KINDS] == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4465758382889437", "4465 7583-8288 9437", "1.2.3.4", "255.256.1.1", "a@b.co", "+1 (706) 555-3138", ".", " ", "-", "7", "İ"]), max_size=12))
def test_joined_pieces(parts):
    text = "".join(parts)
    assert [s for s in pii.spans(text) if s[1] in pii.BASE_KINDS] == brute(text)


def test_more_kinds():
    text = "IBAN: DE89 3704 0044 0532 0130 00, iban DE00 3704 0044 0532 0130 00; SSN 123-45-6789. Token = \"24be64439e3e49cf46b2d7c9\" token passing http://me:pw@host.org/x"
    found = [(k, text[s:e]) for s, k, e in pii.spans(text) if k in pii.MORE_KINDS]
    assert found == [("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789"), ("secret", "24be64439e3e49cf46b2d7c9"), ("login", "http://me:pw@host.org")]


CUES = [*pii.CUES, "IBAN", "Token", "SSN"]
ANY = st.one_of(
    st.text(max_size=8), st.sampled_from([*CUES, "://", "@", "+", ": ", " = ", "#", ".", "-", " ", "\u212a", "\u0130", "\u017f", "\u0661\u0662", "\uff11"]),
    st.sampled_from(["GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 3", "DE89370400440532013000", "123-45-6789", "0123456789abcdef_x", "http://u:p@h.org"]),
    st.integers(1, 400).map(lambda n: "0" * n), st.integers(1, 20).map(lambda n: "9" * n),
)


def more(text):
    """The added kinds: every cue is tried, overlapping ones too; matches of one kind don't overlap."""
    found = [(m.start(), "login", m.end()) for m in re.finditer(r"[A-Za-z0-9+.-]+://[^\s/?#@]+@[A-Za-z0-9.-]+", text)]
    follows = {
        "iban": r"[ :=#.]{0,4}([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})",
        "ssn": r"[ :=#.]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])",
        "secret": r"[ :='\"]{1,6}([A-Za-z0-9_/+=.-]{16,})",
    }
    for kind, pattern in follows.items():
        cues = "|".join(re.escape(c) for c in pii.CUES if pii.CUES[c] == kind)
        starts = sorted({m.start() + len(c) for c in pii.CUES if pii.CUES[c] == kind for m in re.finditer(f"(?ai)(?={re.escape(c)})", text)})
        assert cues
        free = 0
        for start in starts:
            match = re.compile(pattern).match(text, start)
            if not match or match.start(1) < free:
                continue
            value = match[1]
            if kind == "iban":
                moved = value.replace(" ", "").lower()
                moved = moved[4:] + moved[:4]
                remainder = 0
                for c in moved:
                    for digit in str("0123456789abcdefghijklmnopqrstuvwxyz".index(c)):
                        remainder = (remainder * 10 + int(digit)) % 97
                if remainder != 1:
                    continue
            if kind == "secret" and not re.search("[0-9]", value):
                continue
            found.append((match.start(1), kind, match.end(1)))
            free = match.end(1)
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[1])))


@settings(max_examples=1500, deadline=None)
@given(st.lists(ANY, max_size=12).map("".join))
def test_no_text_raises_and_all_kinds_agree_with_plain_code(text):
    found = pii.spans(text)
    assert [s for s in found if s[1] in pii.BASE_KINDS] == brute(text)
    assert [s for s in found if s[1] in pii.MORE_KINDS] == more(text)


def test_odd_texts_give_rows(spark):
    texts = ["iban GB82 WEST 1234 5698 7654 3\u212a", "0" * 5000 + ".1.2.3", "1" * 20_000 + ".1.1.1", "iban \u0130" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.pii] for r in pii.find_pii(docs).collect()}
    assert found == {0: [], 1: [("ip", 0, 5006)], 2: [], 3: []}


def test_time_grows_with_the_length():
    for text in ("://" * 300_000, "a@" * 300_000, "1." * 300_000, "+1" * 300_000, "iban " * 200_000, "token=" * 200_000, "1" * 500_000):
        start = time.perf_counter()
        pii.spans(text)
        assert time.perf_counter() - start < 20


def test_columns(spark):
    rows = [(1, "x é 1.2.3.4", "p"), (1, "x é 1.2.3.4", "p"), (2, None, None), (3, "", "p"), (None, "a@b.co", "p"), (4, "1" * 300_000 + " " + "x" * 300_000 + "@b.co", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    found = sorted((repr(r.doc_id), [(s.kind, s.start, s.end) for s in r.pii]) for r in pii.find_pii(docs).collect())
    assert found == [("1", [("ip", 4, 11)]), ("1", [("ip", 4, 11)]), ("2", []), ("3", []), ("4", [("email", 300_001, 600_006)]), ("None", [("email", 0, 6)])]
    assert pii.find_pii(docs.limit(0)).count() == 0
