"""Conversation repair against brute force: all edits of short code strings, and whole rows in Python."""

import hashlib
import itertools
import random
import zlib

import pytest

from secflow.llm import turns


def brute_codes(codes: str) -> tuple[int, str]:
    """Least (cost, audit) by trying every edit of every row with up to two inserts between rows."""
    best = None

    def walk(i, out, cost, audit):
        nonlocal best
        if best is not None and cost > best[0] or len(out) > len(codes) + 2:
            return
        legal = not out or (len(out.removeprefix("s")) >= 2 and out.removeprefix("s") ==
                            "ua" * (len(out.removeprefix("s")) // 2))
        if i == len(codes) and legal and (best is None or (cost, audit) < best):
            best = cost, audit
        for role in "ua":
            walk(i, out + role, cost + 3, audit + "I")
        if i < len(codes):
            walk(i + 1, out, cost + 4, audit + "D")
            c = codes[i]
            if c != "-":
                extra = 3 if c.isupper() else 0
                if c.lower() != "x":
                    walk(i + 1, out + c.lower(), cost + extra, audit + "K")
                for role in "ua":
                    walk(i + 1, out + role, cost + 3 + extra, audit + "R")

    walk(0, "", 0, "")
    return best


def test_alignment_and_fold_equal_brute_force_on_all_short_codes():
    for n in range(4):
        for codes in map("".join, itertools.product("suaxSUA-", repeat=n)):
            want = brute_codes(codes)
            assert turns.align(codes) == want, codes
            assert turns.fold(codes) == want, codes


def test_alignment_equals_fold_on_long_codes():
    rng = random.Random(3)
    for n in (5, 9, 30, 120):
        for _ in range(60):
            codes = "".join(rng.choices("suaxSUA-", [1, 5, 5, 1, 1, 2, 2, 1], k=n))
            assert turns.align(codes) == turns.fold(codes), codes


def brute_rows(rows):
    """op12 of the given (conv_id, turn, role, text) rows in plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = (" " if x is None else x for x in (role, text))
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            if kind == 0:
                continue
            if kind == 1:
                text = ""
            if kind == 2:
                text = text.translate(str.maketrans("", "", ".!?"))
            if kind == 4:
                role = "user"
            kept += [(turn, role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, codes, counts = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in kept:
            body = text.strip(" \t\n\x0b\f\r")
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("b", "d") and fault else code.upper() if fault == "t" else code
        cost, audit = brute_codes(codes)
        length = sum(audit.count(x) for x in "KRI")
        lines, i = [], 0
        for letter in audit:
            role, text = (None, "") if letter == "I" else kept[i][1:]
            i += letter != "I"
            if letter == "D":
                continue
            left = length - len(lines)
            lines.append(f"{role if letter == 'K' else 'assistant' if left % 2 else 'user'}:{text}")
        numbers = [t for t, _, _ in kept if t is not None]
        legal = ("su", "ua", "au")
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, counts["b"], counts["d"],
                     counts["t"], sum(a[1][:1] + b[1][:1] not in legal for a, b in zip(kept, kept[1:], strict=False)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string, present string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = turns.digests(turns.damage(turns.normal(df))).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in got}


def test_rows_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        turn = 0
        for _ in range(rng.randrange(1, 7)):
            turn += rng.choice([1, 1, 1, 2])
            rows.append((conv, rng.choice([turn] * 9 + [None]) if conv != 7 else None,
                         rng.choice(["system", "user", "user", "assistant", "assistant", None, "tool"]),
                         rng.choice(["Yes.", "Why?", "No", "é !", "", " \n", None, "a.\t", "So: ... x"])))
    # Ties of turn and role would need an order of texts.
    rows = list({r[:3]: r for r in rows}.values())
    assert run(spark, rows) == brute_rows(rows)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    empty = hashlib.sha256(b"").hexdigest()
    assert run(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert run(spark, []) == {}


def test_repair_writes_grammatical_turns_of_a_long_conversation(spark):
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Turn {t}.") for t in range(3000)]
    rows += [(2, 0, "user", "Hello."), (2, 1, "assistant", "Hi.")]
    got = turns.repair(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).orderBy("conv_id", "turn").collect()
    long = [r for r in got if r.conv_id == 1]
    assert [r.turn for r in long] == list(range(len(long)))
    assert "".join(r.role[0] for r in long) == "ua" * (len(long) // 2)
    kept = [r.text for r in long if r.text]
    assert len(kept) > 1500 and set(kept) <= {r[3] for r in rows}
    assert [tuple(r)[1:] for r in got if r.conv_id == 2] == [(0, "user", "Hello."), (1, "assistant", "Hi.")]


@pytest.mark.parametrize("codes,want", [("", (0, "")), ("ua", (0, "KK")), ("sua", (0, "KKK")), ("u", (3, "KI")),
                                        ("s", (4, "D")), ("uu", (3, "KR")), ("-", (4, "D"))])
def test_known_repairs(codes, want):
    assert turns.align(codes) == want
