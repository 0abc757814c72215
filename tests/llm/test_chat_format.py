import pytest

from tests.llm.helpers import rows_of
from tidemark.llm.chat_format import rotate_perspectives

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, position int, own string, perspective string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA)


def expected(rows, part_turns):
    out = []
    for conv in {r[0] for r in rows}:
        own = [(t, r or "unknown", x or "") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        for speaker in {r for _, r, _ in own if r != "system"}:
            for part in range(-(-len(own) // part_turns)):
                text, mask, some = "", [], own[part * part_turns : (part + 1) * part_turns]
                for _, role, said in some:
                    tag = "assistant" if role == speaker else "system" if role == "system" else f"user name={role}"
                    text += f"<|{tag}|>\n"
                    if role == speaker:
                        mask.append(f"{len(text)}-{len(text) + len(said) + 7}")
                    text += said + "<|end|>\n"
                out.append((conv, speaker, part, len(some), text, ",".join(mask)))
    return sorted(out, key=repr)


ODD = [
    (1, 0, "system", "be kind"), (1, 1, "ann", "hé 🙂"), (1, 2, "bob", None), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"), (1, 3, "ann", "aye"), (1, None, "cy", "first"),
    (2, 0, "system", "alone"), (3, 5, None, "who"), (3, 1, "assistant", ""), (None, 1, "ann", "no conversation"), (4, -3, "ann", "x" * 300_000), (4, 2, "bob", "y"),
]


@pytest.mark.parametrize("part_turns", [2, 256])
def test_odd_rows(spark, part_turns):
    assert rows_of(rotate_perspectives(turns(spark, ODD), part_turns)) == expected(ODD, part_turns)


def test_long_conversations_are_many_rows(spark):
    rows = [(1, t, "abc"[t % 3], f"t{t}") for t in range(1500)] + [(2, 7, "ab"[t % 2], f"t{t}") for t in range(700)]
    got = rotate_perspectives(turns(spark, rows), 100)
    assert rows_of(got) == expected(rows, 100)
    assert max(r.n_turns for r in got.collect()) == 100


def test_masks_cut_out_what_the_speaker_said(spark):
    rows = [(1, 0, "ann", "question"), (1, 1, "bob", "answer"), (1, 2, "ann", "thanks")]
    for r in rotate_perspectives(turns(spark, rows)).collect():
        spans = [tuple(map(int, s.split("-"))) for s in r["mask"].split(",")]
        assert [r["text"][a:b] for a, b in spans] == [f"{x}<|end|>" for _, _, role, x in rows if role == r["perspective"]]


def test_empty_table(spark):
    got = rotate_perspectives(turns(spark, []))
    assert got.count() == 0 and got.columns == ["conv_id", "perspective", "part", "n_turns", "text", "mask"]
