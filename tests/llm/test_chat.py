import hashlib
import random
from itertools import takewhile

import pytest

from skytally.llm.chat import against_partner, preference_pairs, whole_conversations

SCHEMA = "pair_id long, side string, turn long, role string, text string, prompt string, place int"


def pairs(spark, *rows):
    frame = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA)
    return {r.pair_id: r for r in preference_pairs(frame).collect()}


def test_prefix_is_rendered_once_and_answers_are_learnt(spark):
    found = pairs(
        spark,
        (1, "chosen", 0, "user", "q"), (1, "rejected", 0, "user", "q"),
        (1, "chosen", 1, "assistant", "good"), (1, "rejected", 1, "assistant", "bad"),
        (1, "rejected", 2, "user", "why"), (1, "rejected", 3, "assistant", "é!"),
    )[1]
    assert (found.n_common, found.prompt) == (1, "<|im_start|>user\nq<|im_end|>\n")
    assert found.chosen == "<|im_start|>assistant\ngood<|im_end|>\n"
    learnt = lambda text, mask: [text[m.start : m.end] for m in mask]
    assert learnt(found.chosen, found.chosen_mask) == ["good<|im_end|>"]
    assert learnt(found.rejected, found.rejected_mask) == ["bad<|im_end|>", "é!<|im_end|>"]


def test_edges(spark):
    found = pairs(
        spark,
        (1, "chosen", 0, "user", "a"),  # one side only
        (2, "chosen", 0, "user", "a"), (2, "rejected", 0, "user", "a"),  # all in common
        (3, "chosen", None, None, None), (3, "rejected", 5, "", ""),  # nulls count as empty
        (4, "chosen", 0, "assistant", "x<|im_end|>"), (4, "rejected", 0, "user", "x<|im_end|>"),
        (5, "chosen", 0, "user", "t"), (5, "chosen", 0, "user", "t"), (5, "rejected", 0, "user", "t"),  # repeated
        (None, "chosen", 0, "user", "a"), (6, "other", 0, "user", "a"),
        (7, "chosen", 0, "user", "w " * 200_000), (7, "rejected", 0, "user", "w " * 200_000 + "x"),
    )
    assert sorted(found) == [1, 2, 3, 4, 5, 7]
    assert (found[1].n_common, found[1].prompt, found[1].rejected, found[1].rejected_mask) == (0, "", "", [])
    assert (found[2].n_common, found[2].chosen, found[2].chosen_mask) == (1, "", [])
    assert found[3].n_common == 1
    assert (found[4].n_common, found[4].chosen.count("<|im_end|>")) == (0, 1)
    assert (found[5].n_common, found[5].chosen.count("t<|"), found[5].rejected) == (1, 1, "")
    assert found[7].n_common == 0 and len(found[7].chosen) > 400_000
    assert pairs(spark) == {}


def test_whole_conversations_keep_every_turn(spark):
    rows = [
        (2, None, "system", "s"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 1, "user", "same number"), (2, 2, "user", "after"),
        (3, None, "system", "s"), (3, 0, "user", "q"), (3, 1, "assistant", "b"),
        (8, 0, "user", "alone"), (None, 0, "user", "nobody"),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pair_id int")
    found = {r.pair_id: r for r in preference_pairs(whole_conversations(frame)).collect()}
    assert sorted(found) == [2, 3, 8]
    piece = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    longer = piece("assistant", "a") + piece("user", "same number") + piece("user", "after")
    assert (found[2].n_common, found[2].prompt) == (2, piece("system", "s") + piece("user", "q"))
    assert (found[2].chosen, found[2].rejected) == (longer, piece("assistant", "b"))
    assert (found[3].chosen, found[3].rejected) == (piece("assistant", "b"), longer)
    assert (found[8].n_common, found[8].chosen, found[8].rejected) == (0, piece("user", "alone"), "")


def plain(conversations, partner):
    """Every conversation formatted by plain loops; ``partner`` gives the rejected turns."""
    by_id = {}
    for conv, turn, role, text in conversations:
        if conv is not None:
            by_id.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    by_id = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in by_id.items()}
    clean = lambda text: text.replace("<|", "< |")

    def side(turns):
        text, learnt = "", []
        for role, said in turns:
            head = f"<|im_start|>{clean(role)}\n"
            body = f"{clean(said)}<|im_end|>"
            if role == "assistant":
                learnt.append((len(text) + len(head), len(text) + len(head) + len(body)))
            text += head + body + "\n"
        return text, learnt

    rows = {}
    for conv, chosen in by_id.items():
        rejected = partner(conv, chosen, by_id.get(conv ^ 1, []))
        common = len(list(takewhile(lambda pair: pair[0] == pair[1], zip(chosen, rejected))))
        rows[conv] = (common, side(chosen[:common])[0], *side(chosen[common:]), *side(rejected[common:]))
    return rows


def kept_then_other(conv, own, other):
    kept = int(hashlib.sha256(str(conv).encode()).hexdigest()[:8], 16) % (len(own) + 1)
    return own[:kept] + other[kept:]


@pytest.mark.parametrize("pairs_of, partner", [(against_partner, kept_then_other), (whole_conversations, lambda c, own, other: other)])
def test_every_turn_against_plain_loops(spark, pairs_of, partner):
    r = random.Random(8)
    rows = [
        (r.randrange(200), r.choice([None, *range(6)]), r.choice(["user", "assistant", "system", None]), r.choice(["a", "b", "é <| x", None, ""]))
        for _ in range(900)
    ]
    rows += [(None, 0, "user", "nobody"), *rows[:40], (900, 0, "user", "w " * 100_000), (900, 1, "assistant", "z")]
    frame = spark.createDataFrame([(*row, 1) for row in rows], "conv_id long, turn long, role string, text string, side int")
    mask = lambda m: [(x.start, x.end) for x in m]
    found = {
        x.pair_id: (x.n_common, x.prompt, x.chosen, mask(x.chosen_mask), x.rejected, mask(x.rejected_mask))
        for x in preference_pairs(pairs_of(frame)).collect()
    }
    assert found == plain(rows, partner)
    assert preference_pairs(pairs_of(frame.limit(0))).count() == 0


def test_prefixes_end_at_many_places(spark):
    from skytally.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op1_preference_format"](spark, sf_dir).groupBy("n_common").count().collect()
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert len(found) > 4 and max(r["count"] for r in found) < 0.6 * turns.select("conv_id").distinct().count()
