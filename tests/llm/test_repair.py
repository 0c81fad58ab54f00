import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from repopulse.llm import repair as R
from tests.llm.samples import seeded

COLUMNS = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")
WORDS = re.compile(r"[^\x20\x09-\x0D]")


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def in_order(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def states(rows):
    """Per row (role, text, gone, short) and the counts of faults."""
    seen, out, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        blank = not WORDS.search(text)
        again = not blank and (role, text) in seen
        seen.add((role, text))
        short = not blank and not again and WORDS.findall(text)[-1] not in ".!?"
        for k, one in enumerate((blank, again, short)):
            counts[k] += one
        out.append((role, text, blank or again, short))
    return out, counts


def fits(initials):
    return PATTERN.fullmatch(initials) is not None


def every_way(rows, inserts=2):
    """All edits of a short conversation with at most so many inserts at one place."""
    choices = []
    for role, text, gone, short in rows:
        own = [("D", 4, None)]
        if not gone:
            own.append(("K", 3 * short, (role, text)))
            own += [("R", 3 + 3 * short, (new, text)) for new in ("user", "assistant")]
        choices.append(own)
    added = [list(itertools.product(("user", "assistant"), repeat=n)) for n in range(inserts + 1)]
    places = [x for group in added for x in group]
    for edits in itertools.product(*choices):
        for before in itertools.product(places, repeat=len(rows) + 1):
            audit, cost, out = "", 0, []
            for k in range(len(rows) + 1):
                audit, cost = audit + "I" * len(before[k]), cost + 3 * len(before[k])
                out += [(role, "") for role in before[k]]
                if k < len(rows):
                    letter, more, left = edits[k]
                    audit, cost = audit + letter, cost + more
                    out += [left] if left else []
            if fits("".join(role[:1] or "?" for role, _ in out)):  # without an initial no row can stay as it is
                yield cost, audit, out


def by_states(rows):
    """The cheapest repair, ties by audit, with one best way for each state."""
    best = {"": (0, "", ())}

    def next_of(state, role):
        initial = role[:1]
        ok = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        return initial if initial and initial in ok else None

    def widened(now):
        for _ in range(3):
            for state, (cost, audit, out) in list(now.items()):
                for role in ("user", "assistant"):
                    if (to := next_of(state, role)) is not None:
                        found = (cost + 3, audit + "I", (*out, (role, "")))
                        now[to] = min(now.get(to, found), found)
        return now

    for role, text, gone, short in rows:
        after = {}
        for state, (cost, audit, out) in widened(best).items():
            ways = [(state, cost + 4, audit + "D", out)]
            if not gone:
                extra = 3 * short
                for new, letter, price in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if (to := next_of(state, new)) is not None:
                        ways.append((to, cost + price + extra, audit + letter, (*out, (new, text))))
            for to, *found in ways:
                after[to] = min(after.get(to, tuple(found)), tuple(found))
        best = after
    return min(x for state, x in widened(best).items() if state in ("", "a"))


def by_hand(rows, original):
    out = {}
    for conv in {r[0] for r in original}:
        own = in_order([r[1:] for r in rows if r[0] == conv])
        known, counts = states(own)
        cost, audit, left = by_states(known) if own else (0, "", ())
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(known, known[1:]))
        text = "\n".join(f"{r}:{x}" for r, x in left)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_states_give_the_cheapest_of_all_ways():
    rng = seeded(3)
    for _ in range(60):
        own = in_order([r[1:] for r in plain(rng, rng.choice([1, 2, 2]), 0)])
        known, _ = states(own)
        cost, audit, left = by_states(known)
        least = min(every_way(known))
        assert (cost, audit, list(left)) == least


def plain(rng, many, conv):
    rows = []
    for k in range(many):
        role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
        text = rng.choice(["yes.", "no!", "why? ", "well", "and so \n", "", " \t", None, f"{rng.randrange(9)}."])
        rows.append((conv, k if rng.random() < 0.9 else None, role, text))
    return rows


def sample(rng):
    rows = [r for conv in range(80) for r in plain(rng, rng.choice([1, 2, 3, 5, 8, 13]), conv)]
    rows += plain(rng, 400, 100) + plain(rng, 90, None)
    # Equal rows, one turn many times, gaps, a conversation of one state for long.
    rows += [(101, 5, "user", "again.")] * 7 + [(102, 9 * k, "user", f"{k}.") for k in range(50)]
    return rows


@pytest.mark.parametrize("chunk,fan", [(4096, 256), (7, 3), (1, 2)])
def test_summaries_equal_those_by_hand(spark, chunk, fan):
    rows = sample(seeded(1))
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 as block", "2 as position", "'x' as audit", "0 as kind", "3 as cost")
    assert found(R.summaries(R.planned(df, df, chunk, fan))) == by_hand(rows, rows)


def test_damaged_rows(spark):
    rows = sample(seeded(2)) + [(k, 0, "user", "Only. One! Row?") for k in range(200, 300)]
    df = spark.createDataFrame(rows, COLUMNS)
    hurt = damaged_by_hand(rows)
    assert sorted(map(tuple, R.damaged(df).collect()), key=str) == sorted(hurt, key=str)
    got = found(R.summaries(R.planned(R.damaged(df), df)))
    assert got == by_hand(hurt, rows)
    gone = {c for c, *_ in rows} - {c for c, *_ in hurt}
    assert gone and all(got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)


def test_repaired_rows_are_in_order(spark):
    rows = sample(seeded(4))
    plan = R.planned(spark.createDataFrame(rows, COLUMNS), chunk=16, fan=4)
    out = {}
    for r in R.repaired(plan).orderBy("conv_id", "position").collect():
        out.setdefault(r.conv_id, []).append(r)
    told = found(R.summaries(plan))
    for conv, own in out.items():
        assert [r.position for r in own] == list(range(len(own)))
        assert fits("".join(r.role[:1] for r in own))
        assert "".join(r.edit for r in own) == told[conv][6].replace("D", "")
        text = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == told[conv][7]


def test_rules_have_the_matrices_and_audits_of_their_rows():
    rng = seeded(5)
    grammar = R.Grammar()
    for _ in range(60):
        many = len(R.SYMBOLS) + len(grammar.rules)
        grammar.add(rng.randrange(many), rng.randrange(many))

    def rows(symbol):
        if symbol < len(R.SYMBOLS):
            return [symbol]
        return [x for part in grammar.rules[symbol - len(R.SYMBOLS)] for x in rows(part)]

    for symbol in range(len(R.SYMBOLS), len(R.SYMBOLS) + 60):
        if len(rows(symbol)) > 500:
            continue
        best = {(i, i): (0, "") for i in range(4)}
        for one in rows(symbol):
            after = {}
            for (i, k), (cost, audit) in best.items():
                for (begin, j), own in grammar.audits[one].items():
                    if begin == k:
                        made = (cost + int(grammar.matrices[one].cost[k, j]), audit + own)
                        after[i, j] = min(after.get((i, j), made), made)
            best = after
        matrix = grammar.matrices[symbol]
        order = sorted({audit for _, audit in best.values()})
        for i, j in itertools.product(range(4), repeat=2):
            if (i, j) not in best:
                assert matrix.cost[i, j] == R.NEVER
                continue
            cost, audit = best[i, j]
            assert (matrix.cost[i, j], grammar.open(symbol, i, j), matrix.rank[i, j]) == (cost, audit, order.index(audit))


def test_pairs_are_replaced_by_frequency(spark):
    texts = ["suauaua"] * 3 + ["uauauaua"] * 5 + ["uuuuu"] * 2 + ["w"]
    df = spark.createDataFrame([(t, texts.count(t)) for t in set(texts)], "symbols string, many long")
    grammar = R.learnt(df)
    letters = list(R.SYMBOLS)
    for left, right in grammar.rules:
        letters.append(letters[left] + letters[right])
    assert letters[len(R.SYMBOLS)] == "ua"  # the most frequent pair
    assert "uauauaua" in letters  # rules of rules
    for text, seq in zip(texts, grammar.sequences(texts)):
        assert "".join(letters[s] for s in seq) == text
        assert len(seq) < len(text) or len(text) == 1
    assert len(R.learnt(df, 2, 1).rules) == 2


def test_no_rows(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert found(R.summaries(R.planned(empty, empty))) == {}
    one = spark.createDataFrame([(1, None, None, None)], COLUMNS)
    assert found(R.summaries(R.planned(one))) == {1: (0, 1, 0, 0, 0, 4, "D", hashlib.sha256(b"").hexdigest())}
    assert found(R.summaries(R.planned(empty, one))) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_runs_of_one_symbol_are_paired_from_the_left():
    grammar = R.Grammar()
    grammar.add(0, 0)
    flat = R.flattened(["s" * 5, "s", "", "ss"])
    assert grammar.rewrite(flat).tolist() == [12, 12, 0, -1, 0, -1, -1, 12, -1]
    assert [list(x) for x in grammar.sequences(["sss", "", "u"])] == [[12, 0], [], [1]]
    assert np.array_equal(grammar.rewrite(np.array([-1], np.int32)), [-1])
