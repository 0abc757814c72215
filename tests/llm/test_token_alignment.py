import hashlib
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import docs_of, odd_rows
from tidemark.llm import token_alignment as ta
from tidemark.llm.common import with_package

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def both_sides():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plainly(rows):
    """Whole texts by the libraries, links by looking at every pair of tokens."""
    a, b = both_sides()
    letters = ta._letters()
    told, counts = [], Counter()
    for doc_id, text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        xb = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        yb = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]]
        if not text or b"".join(xb) != (" " + text).encode() or b"".join(yb) != (" " + text).encode():
            told.append((doc_id, [], [], [], []))
            continue
        spans = []
        for side in (xb, yb):
            at, own = 0, []
            for t in side:
                own.append((at, at + len(t)))
                at += len(t)
            spans.append(own)
        links = [(i, j) for i, (s, e) in zip(x, spans[0]) for j, (u, v) in zip(y, spans[1]) if s < v and u < e]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, begin = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own) if begin < e <= end) for ids, own in zip((x, y), spans)))
            begin = end
        counts.update(links)
        told.append((doc_id, x, y, groups, links))
    top = defaultdict(int)
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    return [
        (d, len(x), len(y), len(g), len(ln), sum(counts[p] == top[p[1]] for p in ln), sum(counts[p] for p in ln), hashlib.sha256(";".join(g).encode()).hexdigest() if x else "")
        for d, x, y, g, ln in told
    ]


TEXTS = [
    "Tokenizers disagree about words, unbelievably often.",
    " leading and trailing  ",
    "line\nbreaks\n\n  and\ttabs\r\n ends\n",
    "<|endoftext|> <s> </s> <unk> <0x41> plain",
    "a▁b cannot be told apart",
    "Größe, naïve café; 日本語のテキスト 한국어 русский 🙂🙃",
    "x y z ​ w v",
    " ",
    "\n",
    "aaaa" * 50,
    "1234567890 3.14159 $%^&* ((()))",
    "it's we'll they'd I'M",
]


def answers(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_all_pairs(spark):
    rows = [(i, t) for i, t, _ in odd_rows() if t is None or len(t) < 3000] + [(100 + k, t) for k, t in enumerate(TEXTS)] + [(100, TEXTS[0])]
    found = ta.align_tokenizers(docs_of(with_package(spark), [(i, t, "s") for i, t in rows]).repartition(3), A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert answers(found) == sorted(plainly(rows), key=repr)


def test_fragments_in_any_order():
    """Ranges of seven bytes cut words and characters apart; composed in any order they give what whole texts give."""
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(50, "short"), (51, None), (52, " ".join(TEXTS[:3]) * 4), (None, TEXTS[0])]
    aligner = ta.Aligner(open(A, "rb").read(), open(B, "rb").read())
    for _, text in rows:
        if not text:
            continue
        raw = (" " + text).encode()
        units = aligner.units(text)
        edges = sorted({0, *range(7, len(raw), 7), len(raw)})
        cuts, at = [0], 0
        for u in units:
            at += len(u.encode())
            cuts.append(at)
        parts, bad = [], False
        for k, (s, e) in enumerate(zip(edges, edges[1:])):
            low, high = max(c for c in cuts if c <= s), min(c for c in cuts if c >= e)
            one = ta.fragment(aligner, raw[low:high].decode(), low, s, e)
            bad |= one is None
            parts.append(one and ((one[1], k, *one[0]), ";".join(p[2] for p in one[2])))
        if bad:
            assert plainly([(0, text)])[0][1] == 0
            continue
        for order in ("left", "right", "tree"):
            todo, seams = [p[0] for p in parts], []
            while len(todo) > 1:
                i = 0 if order == "left" else len(todo) - 2 if order == "right" else (len(todo) - 1) // 2
                todo[i : i + 2], seam = [ta.compose(todo[i], todo[i + 1])[0]], ta.compose(todo[i], todo[i + 1])[1]
                if seam:
                    seams.append(seam)
            assert todo[0][0] and not todo[0][4] and not todo[0][5]
            seams.append((todo[0][1], todo[0][2], todo[0][3]))
            told = [(k, 0, aligner.steps(x, y)[0]) for k, x, y in seams] + [(k, 1, p[1]) for k, p in enumerate(parts) if p[1]]
            groups = ";".join(x for _, _, x in sorted(told))
            assert hashlib.sha256(groups.encode()).hexdigest() == plainly([(0, text)])[0][7]


def test_very_long_texts(spark):
    """Longer than a range: with blanks, without any, and one that has to be left without tokens."""
    words = " ".join(f"wörd{k * 7919 % 10007}" for k in range(40_000))
    rows = [(1, words), (2, "xyzé" * 40_000), (3, words + "▁"), (4, words), (None, words[:100]), (5, words[:70_000] + "\n\n" + words[:90_000])]
    found = {r["doc_id"]: r for r in ta.align_tokenizers(docs_of(with_package(spark), [(i, t, "s") for i, t in rows]), A, B).collect()}
    aligner = ta.Aligner(open(A, "rb").read(), open(B, "rb").read())
    a, b = both_sides()
    for doc_id, text in rows:
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        got = found[doc_id]
        if doc_id == 3:
            assert tuple(got)[1:] == (0, 0, 0, 0, 0, 0, "")
            continue
        told, links, n = aligner.steps(x, y)
        assert (got.n_a, got.n_b, got.n_groups, got.n_links) == (len(x), len(y), n, len(links))
        assert got.groups_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert tuple(found[1])[1:] == tuple(found[4])[1:]


def test_empty_table(spark):
    assert ta.align_tokenizers(docs_of(with_package(spark), []), A, B).collect() == []
