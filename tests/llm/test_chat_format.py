import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from loadcast.llm import chat_format as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@given(st.text(alphabet="<|\\im_end>a\n", max_size=30), st.text(alphabet="<|\\%0A\nuser>", max_size=10))
def test_escaping_is_reversible(text, role):
    t = C.MarkedTemplate()
    assert t.unescape(t.escape(text)) == text and t.unescape_role(t.escape_role(role)) == role
    assert "<|" not in t.escape(text)
    out = t([(role, text), ("assistant", text)])
    assert [(r, x) for r, x, _, _ in t.read(out)] == [(role, text), ("assistant", text)]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text(alphabet="ab<|\n", max_size=8)), min_size=1,
                max_size=50))
def test_pieces_join_to_the_full_rendering(turns):
    t = C.MarkedTemplate()
    run = C.IncrementalRenderer(t)
    spans = [run.add(*turn) for turn in turns]
    assert "".join(s.piece for s in spans) == t(turns)
    assert [t.unescape(s.piece[s.text_start:s.text_end]) for s in spans] == [x for _, x in turns]
    assert all(s.rewritten_at == -1 for s in spans)


def header_once(turns):
    """Begins with a preamble; closes nothing."""
    return "PREAMBLE\n" + "".join(f"[{r}]{x}" for r, x in turns)


def forgets_old_answers(turns):
    """Rewrites history: earlier assistant texts are blanked once the user speaks again."""
    last = max((i for i, (r, _) in enumerate(turns) if r == "user"), default=0)
    return "".join(f"[{r}]{x if r == 'user' or i > last else '...'}" for i, (r, x) in enumerate(turns))


def counts_turns(turns):
    """Not local: every turn shows its number."""
    return "".join(f"<{i}:{r}>{x}\n" for i, (r, x) in enumerate(turns))


def test_black_box_templates():
    turns = [("user", "hello"), ("assistant", "hi there"), ("user", "more"), ("assistant", "yes")]
    run = C.IncrementalRenderer(header_once)
    spans = [run.add(*t) for t in turns]
    assert "".join(s.piece for s in spans) == header_once(turns)
    assert [s.piece[s.text_start:s.text_end] for s in spans] == [x for _, x in turns]
    run = C.IncrementalRenderer(forgets_old_answers)
    spans = [run.add(*t) for t in turns]
    assert [s.rewritten_at >= 0 for s in spans] == [False, False, True, False] and not run.local
    run = C.IncrementalRenderer(counts_turns)
    many = [("user", f"text {i}") for i in range(60)]
    assert "".join(run.add(*t).piece for t in many) == counts_turns(many) and not run.local


def keeps_the_last_40(turns):
    """Local at first: a sliding window that drops the oldest turns of a long conversation."""
    return "".join(f"[{r}]{x}\n" for r, x in turns[-40:])


def test_rewrites_late_in_a_long_conversation_are_detected():
    run = C.IncrementalRenderer(keeps_the_last_40)
    turns = [("user", f"text {i}") for i in range(100)]
    before = ""
    for i in range(len(turns)):
        out = keeps_the_last_40(turns[:i + 1])
        same = next((k for k, (x, y) in enumerate(zip(before, out)) if x != y), min(len(before), len(out)))
        span = run.add(*turns[i])
        assert span.rewritten_at == (-1 if same == len(before) else same)
        assert (i >= 40) == (span.rewritten_at >= 0)
        assert span.piece == out[same:]
        before = out


def test_a_long_conversation_streams():
    run = C.IncrementalRenderer(C.MarkedTemplate())
    turns = [("user", "u" * (i % 9)) for i in range(500)]
    assert "".join(run.add(*t).piece for t in turns) == C.MarkedTemplate()(turns)
    assert run.local and not run.turns


def brute(rows):
    t, out, by = C.MarkedTemplate(), {}, {}
    for c, n, r, x in rows:
        by.setdefault(c, []).append((n is not None, n or 0, r or "", x or ""))
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), len(t(turns)), 0)
    return out


def test_digests_match_brute_force(spark):
    r = random.Random(5)
    text = lambda: r.choice(["", "<|im_end|>", "a < b | c", "<\\|im_start|>x", "line\nline", "🙂" * 3, None])
    rows = [(i // 4, i % 4, r.choice(["user", "assistant", "system", None]), text()) for i in range(200)]
    rows += [(900, i, "assistant" if i % 2 else "user", "hot") for i in range(300)]
    rows += [(None, 1, "user", "no id"), (None, 0, "assistant", "first"), (901, None, "user", "null turn"),
             (901, 0, "user", "x"), (902, 0, "user", "tie"), (902, 0, "user", "tie"), (903, 0, "assistant", "z" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 AS piece", "2 AS loss")
    got = {x.conv_id: tuple(x)[1:] for x in C.conversation_digests(df).collect()}
    assert got == brute(rows)


def test_empty_table(spark):
    assert C.conversation_digests(spark.createDataFrame([], SCHEMA)).count() == 0
