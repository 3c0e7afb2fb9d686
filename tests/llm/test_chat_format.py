import hashlib
import random

from glossaria.llm import chat_format as c


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, speaker string")


def plain(messages, me):
    out, mask = "", []
    for role, text in messages:
        who = "assistant" if role == me else "system" if role == "system" else f"user name={role}" if role else "user"
        out += f"<|im_start|>{who}\n"
        if role == me:
            mask.append((len(out), len(out) + len(text) + len("<|im_end|>")))
        out += f"{text}<|im_end|>\n"
    return out, mask


def in_order(rows):
    """Messages of one dialogue, (turn, role, text), once each."""
    key = lambda m: (m[0] is not None, m[0] or 0, hashlib.md5(f"{m[1] or ''}:{m[2]}".encode()).hexdigest(), m[1] is not None, m[1])
    return [(r, t) for _, r, t in sorted(set(rows), key=key)]


def assert_views(views, rows):
    """``views`` are those of the dialogue of ``rows``, one for each speaker, whole and in parts of bounded size."""
    said = in_order(rows)
    by = {}
    for v in sorted(views, key=lambda v: v["part"]):
        by.setdefault(v["speaker"], []).append(v)
    assert set(by) == {r for r, _ in said if r and r != "system"}
    for speaker, parts in by.items():
        text, mask = plain(said, speaker)
        assert [v["part"] for v in parts] == list(range(len(parts)))
        assert "".join(v["rendered"] for v in parts) == text
        assert [(m["start"], m["end"]) for v in parts for m in v["mask"]] == mask
        assert sum(v["n_messages"] for v in parts) == len(said)
        assert all(text[v["start"] :].startswith(v["rendered"]) for v in parts)
        messages = [m for v in parts for m in v["messages"]]
        assert [m["number"] for m in messages] == list(range(len(said)))
        assert all(text[m["start"] :].startswith(m["rendered"]) for m in messages)
        assert [(m["mask_start"], m["mask_end"]) for m in messages if m["mask_start"] is not None] == mask
    return by


def test_every_speaker_gets_a_view(spark):
    said = [("system", "be kind"), ("ann", "hi 🙂"), ("bob", "hello\nthere"), ("cy", ""), ("ann", "bye")]
    rows = c.rotate(turns(spark, [(1, i, r, t, "own") for i, (r, t) in reversed(list(enumerate(said)))])).collect()
    assert len(assert_views(rows, [(i, r, t) for i, (r, t) in enumerate(said)])) == 3


def test_odd_rows(spark):
    rows = [(1, 0, "a", "x", "")] * 3 + [(1, 0, "b", "x", ""), (1, None, "a", None, ""), (None, 1, None, "who", ""), (None, 1, "a", "me", ""), (2, 0, "system", "alone", ""), (3, 5, None, "nobody", "")]
    for crowd in (c.CROWD, 1):  # short ones, and the same dialogues dealt out as long ones
        views = c.rotate(turns(spark, rows), crowd=crowd).collect()
        assert {v["conv_id"] for v in views} == {1, None}
        for conv in (1, None):
            assert_views([v for v in views if v["conv_id"] == conv], [(t, r, x or "") for k, t, r, x, _ in rows if k == conv])


def test_whole_long_dialogues_for_every_speaker(spark):
    """1,500 turns, with a speaker of one turn, beside a short dialogue."""
    rows = [(i, "once" if i == 3 else "ab"[i % 2], f"m{i}") for i in range(1500)]
    views = c.rotate(turns(spark, [(7, *r, "") for r in rows] + [(8, 0, "a", "x", "")])).collect()
    by = assert_views([v for v in views if v["conv_id"] == 7], rows)
    assert len(by["once"]) == len(by["a"]) > 1 and max(v["n_messages"] for v in views) <= c.PART_TURNS
    assert_views([v for v in views if v["conv_id"] == 8], [(0, "a", "x")])


def test_null_and_equal_turns_are_dealt_out(spark):
    rng = random.Random(4)
    rows = [(rng.choice((None, 5, 5, 300)), rng.choice(("a", "b", None)), f"m{i}") for i in range(600)] + [(5, "a", "same")] * 300
    views = c.rotate(turns(spark, [(1, *r, "") for r in rows]), part_turns=10, crowd=20).collect()
    assert_views(views, rows)
    assert max(v["n_messages"] for v in views) <= 40


def test_very_long_text(spark):
    rows = [(0, "a", "long " * 300_000), (1, "b", "short")]
    assert_views(c.rotate(turns(spark, [(1, *r, "") for r in rows])).collect(), rows)


def test_empty(spark):
    assert c.rotate(turns(spark, [])).count() == 0
