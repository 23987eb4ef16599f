"""Memories in prose: segments, marker scores, sentiment, and the noise and code around them."""

from __future__ import annotations

import functools
import re

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound, strip
from .chunks import paragraph_parts

#: What marks each kind of memory, in order of precedence.
MARKERS = {
    "decision": [
        r"\blet'?s (use|go with|try|pick|choose|switch to)\b", r"\bwe (should|decided|chose|went with|picked|settled on)\b", r"\bi'?m going (to|with)\b",
        r"\bbetter (to|than|approach|option|choice)\b", r"\binstead of\b", r"\brather than\b", r"\bthe reason (is|was|being)\b", r"\bbecause\b", r"\btrade-?off\b",
        r"\bpros and cons\b", r"\bover\b.*\bbecause\b", r"\barchitecture\b", r"\bapproach\b", r"\bstrategy\b", r"\bpattern\b", r"\bstack\b", r"\bframework\b",
        r"\binfrastructure\b", r"\bset (it |this )?to\b", r"\bconfigure\b", r"\bdefault\b",
    ],
    "preference": [
        r"\bi prefer\b", r"\balways use\b", r"\bnever use\b", r"\bdon'?t (ever |like to )?(use|do|mock|stub|import)\b", r"\bi like (to|when|how)\b",
        r"\bi hate (when|how|it when)\b", r"\bplease (always|never|don'?t)\b", r"\bmy (rule|preference|style|convention) is\b", r"\bwe (always|never)\b",
        r"\bfunctional\b.*\bstyle\b", r"\bimperative\b", r"\bsnake_?case\b", r"\bcamel_?case\b", r"\btabs\b.*\bspaces\b", r"\bspaces\b.*\btabs\b", r"\buse\b.*\binstead of\b",
    ],
    "milestone": [
        r"\bit works\b", r"\bit worked\b", r"\bgot it working\b", r"\bfixed\b", r"\bsolved\b", r"\bbreakthrough\b", r"\bfigured (it )?out\b", r"\bnailed it\b",
        r"\bcracked (it|the)\b", r"\bfinally\b", r"\bfirst time\b", r"\bfirst ever\b", r"\bnever (done|been|had) before\b", r"\bdiscovered\b", r"\brealized\b",
        r"\bfound (out|that)\b", r"\bturns out\b", r"\bthe key (is|was|insight)\b", r"\bthe trick (is|was)\b", r"\bnow i (understand|see|get it)\b", r"\bbuilt\b",
        r"\bcreated\b", r"\bimplemented\b", r"\bshipped\b", r"\blaunched\b", r"\bdeployed\b", r"\breleased\b", r"\bprototype\b", r"\bproof of concept\b", r"\bdemo\b",
        r"\bversion \d", r"\bv\d+\.\d+", r"\d+x (compression|faster|slower|better|improvement|reduction)", r"\d+% (reduction|improvement|faster|better|smaller)",
    ],
    "problem": [
        r"\b(bug|error|crash|fail|broke|broken|issue|problem)\b", r"\bdoesn'?t work\b", r"\bnot working\b", r"\bwon'?t\b.*\bwork\b", r"\bkeeps? (failing|crashing|breaking|erroring)\b",
        r"\broot cause\b", r"\bthe (problem|issue|bug) (is|was)\b", r"\bturns out\b.*\b(was|because|due to)\b", r"\bthe fix (is|was)\b", r"\bworkaround\b", r"\bthat'?s why\b",
        r"\bthe reason it\b", r"\bfixed (it |the |by )\b", r"\bsolution (is|was)\b", r"\bresolved\b", r"\bpatched\b", r"\bthe answer (is|was)\b", r"\b(had|need) to\b.*\binstead\b",
    ],
    "emotional": [
        r"\blove\b", r"\bscared\b", r"\bafraid\b", r"\bproud\b", r"\bhurt\b", r"\bhappy\b", r"\bsad\b", r"\bcry\b", r"\bcrying\b", r"\bmiss\b", r"\bsorry\b", r"\bgrateful\b",
        r"\bangry\b", r"\bworried\b", r"\blonely\b", r"\bbeautiful\b", r"\bamazing\b", r"\bwonderful\b", r"i feel", r"i'm scared", r"i love you", r"i'm sorry", r"i can't",
        r"i wish", r"i miss", r"i need", r"never told anyone", r"nobody knows", r"\*[^*]+\*",
    ],
}
#: Words of good and bad news.
POSITIVE = (
    "pride", "proud", "joy", "happy", "love", "loving", "beautiful", "amazing", "wonderful", "incredible", "fantastic", "brilliant", "perfect", "excited",
    "thrilled", "grateful", "warm", "breakthrough", "success", "works", "working", "solved", "fixed", "nailed", "heart", "hug", "precious", "adore",
)
NEGATIVE = (
    "bug", "error", "crash", "crashing", "crashed", "fail", "failed", "failing", "failure", "broken", "broke", "breaking", "breaks", "issue", "problem", "wrong",
    "stuck", "blocked", "unable", "impossible", "missing", "terrible", "horrible", "awful", "worse", "worst", "panic", "disaster", "mess",
)
#: How a solved problem, a line of code, a speaker's turn and a line of noise look. Those of code and turns all
#: begin at a line's start, which one mark before all of them tells at once.
RESOLVED = r"\bfixed\b|\bsolved\b|\bresolved\b|\bpatched\b|\bgot it working\b|\bit works\b|\bnailed it\b|\bfigured (it )?out\b|\bthe (fix|answer|solution)\b"
CODE_LINES = (
    r"^[\$#]\s", r"^(cd|source|echo|export|pip|npm|git|python|bash|curl|wget|mkdir|rm|cp|mv|ls|cat|grep|find|chmod|sudo|brew|docker)\s", r"^```",
    r"^(import|from|def|class|function|const|let|var|return)\s", r"^[A-Z_]{2,}=", r"^\|", r"^[-]{2,}", r"^[{}\[\]]$", r"^(if|for|while|try|except|elif|else:)\b",
    r"^\w+\.\w+\(", r"^\w+ = \w+\.\w+",
)
TURNS = r"^>\s|(?i)^(human|user|q)\s*:|^(assistant|ai|a|claude|chatgpt)\s*:"
NOISE_TAGS = ("system-reminder", "command-message", "command-name", "task-notification", "user-prompt-submit-hook", "hook_output")
NOISE_LINES = (
    "CURRENT TIME:", "VERIFIED FACTS (do not contradict)", "AGENT SPECIALIZATION:", "Checking verified facts...", "Injecting timestamp...",
    "Starting background pipeline...", "Checking emotional weights...", "Auto-save reminder...", "Checking pipeline...",
)
HOOKS = "Stop|PreCompact|PreToolUse|PostToolUse|UserPromptSubmit|Notification|SessionStart|SessionEnd"


def without_noise(text: Column, lines: tuple[str, ...] = NOISE_LINES) -> Column:
    """A transcript without injected tags, status lines and folded output. Every pattern begins at a line's start and
    stays within a paragraph, so an open tag of one message never takes text from the next."""
    for name in NOISE_TAGS:
        text = F.regexp_replace(text, rf"(?m)^(?:> )?<{name}(?:\s[^>]*)?>(?:(?!\n\s*\n)[\s\S])*?</{name}>[ \t]*\n?", "")
    for line in lines:
        text = F.regexp_replace(text, rf"(?m)^(?:> )?{re.escape(line)}.*\n?", "")
    text = F.regexp_replace(text, rf"(?m)^(?:> )?Ran \d+ (?:{HOOKS}) hooks?.*\n?", "")
    text = F.regexp_replace(text, r"(?m)^(?:> )?…\s*\+\d+ lines.*\n?", "")
    text = F.regexp_replace(text, r"\s*\[\d+\s+tokens?\]\s*\(ctrl\+o to expand\)", "")
    return strip(F.regexp_replace(text, r"\n{4,}", "\n\n\n"))


def is_code(line: Column) -> Column:
    """Whether a stripped line looks like code: by its beginning, or because fewer than two fifths are letters."""
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    sparse = (F.length(line) > 10) & (letters < 0.4 * F.length(line))
    return (line != "") & (line.rlike(f"^(?:{'|'.join(CODE_LINES)})") | sparse)


def prose(text: Column) -> Column:
    """A text without fenced blocks and code lines; the text itself if nothing else is left."""
    open_text = F.regexp_replace(text, r"(?ms)^[^\S\n]*```.*?(?:^[^\S\n]*```[^\n]*(?:\n|\z)|\z)", "")
    kept = strip(F.array_join(F.filter(F.split(open_text, "\n"), lambda x: ~bound(strip(x), is_code)), "\n"))
    return F.coalesce(F.nullif(kept, F.lit("")), text)


def segments(text: Column) -> Column:
    """A text by speakers' turns, if it has at least three; else by paragraphs, or groups of lines without any."""
    lines = F.split(text, "\n")
    turn = lambda x: strip(x).rlike(f"^(?:{TURNS})")
    marked = F.transform(lines, lambda x, i: F.when((i > 0) & turn(x), F.concat(F.lit("\u0001"), x)).otherwise(x))
    by_turn = F.split(F.array_join(marked, "\n"), "\n\u0001")
    return F.when(F.size(F.filter(lines, turn)) >= 3, by_turn).otherwise(paragraph_parts(text))


def anchors(pattern: str) -> list[str]:
    """Literals of which a pattern needs at least one: the longest one outside of groups, or, if there is none, the
    alternatives of its group. Only for patterns as simple as the markers: no nested groups, no alternatives outside."""
    plain = re.sub(r"\\b|\\d[+*]?|\.\*|\[[^\]]*\][+*]?|(?<!\\)\\(?=[*.])", "\0", pattern).replace("\0*", "\0\1").replace("\0.", "\0\2")
    outside = re.sub(r".\?", "\0", re.sub(r"\([^)]*\)\??", "\0", plain))
    longest = max(outside.split("\0"), key=len).replace("\1", "*").replace("\2", ".")
    if longest.strip():
        return [longest]
    group = re.search(r"\(([^)]*)\)(?!\?)", plain)
    return [max(re.sub(r".\?", "\0", x).split("\0"), key=len) for x in group[1].split("|")]


@functools.cache
def _scorer() -> tuple[ahocorasick.Automaton, list[list[tuple[int, re.Pattern]]]]:
    """The automaton over all markers' anchors, and for each anchor the (kind, marker) it lets in; per worker."""
    gated: dict[str, list[tuple[int, re.Pattern]]] = {}
    for kind, markers in enumerate(MARKERS.values()):
        for m in markers:
            for a in anchors(m):
                gated.setdefault(a, []).append((kind, re.compile(m)))
    automaton = ahocorasick.Automaton()
    for n, a in enumerate(gated):
        automaton.add_word(a, n)
    automaton.make_automaton()
    return automaton, list(gated.values())


def scores(text: str) -> list[int]:
    """How often the markers of each kind occur in a lower-case text. One pass finds the anchors; only markers that one
    of them lets in are searched for, each once."""
    automaton, gated = _scorer()
    out = [0] * len(MARKERS)
    for kind, marker in {x for n in {n for _, n in automaton.iter(text)} for x in gated[n]}:
        out[kind] += sum(1 for _ in marker.finditer(text))
    return out


def marker_scores(low: Column) -> Column:
    """The scores of a lower-case text as a struct with a field for each kind."""

    @F.pandas_udf(", ".join(f"{k} int" for k in MARKERS))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scores(t or "") for t in texts], columns=list(MARKERS))

    return run(low)


def sentiment(text: Column) -> Column:
    """positive, negative or neutral, by the different good and bad words in a text."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), 0))
    good, bad = (F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in ws]))) for ws in (POSITIVE, NEGATIVE))
    return F.when(good > bad, "positive").when(bad > good, "negative").otherwise("neutral")


def memories(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """(id, chunk_index, memory_type, document): the segments of (id, document) that markers make memories.

    A segment of at least 20 stripped characters takes the kind with most marks in its prose (the first of equals). Its
    confidence is a fifth of the marks, and of one more for over 200 characters and two for over 500, at most 1. A
    problem that is solved is a milestone, or emotional if it was glad news; one told as good news becomes what else it
    has marks of. Texts are dealt by id first, so that a file's large row group is not one task's work.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select("id", "document").repartition(tasks, "id")
    d = d.select("id", F.posexplode(segments(F.coalesce("document", F.lit("")))).alias("part", "segment"))
    d = d.where(F.length(strip(F.col("segment"))) >= 20)
    d = d.withColumn("prose", prose(F.col("segment"))).withColumn("scores", marker_scores(F.lower("prose")))
    d = d.select("id", "part", "segment", "prose", "scores.*")
    top = F.greatest(*MARKERS)
    d = d.withColumn("top", top).where("top > 0").withColumn("kind", F.coalesce(*[F.when(F.col(k) == F.col("top"), F.lit(k)) for k in MARKERS]))
    bonus = F.when(F.length("segment") > 500, 2).when(F.length("segment") > 200, 1).otherwise(0)
    d = d.where(F.least(F.lit(1.0), (F.col("top") + bonus) / 5.0) >= least)
    glad, solved, problem = sentiment(F.col("prose")) == "positive", F.lower("prose").rlike(RESOLVED), F.col("kind") == "problem"
    kind = F.when(problem & solved, F.when((F.col("emotional") > 0) & glad, "emotional").otherwise("milestone"))
    kind = F.coalesce(kind, F.when(problem & glad & (F.col("milestone") > 0), "milestone"), F.when(problem & glad & (F.col("emotional") > 0), "emotional"), F.col("kind"))
    nth = F.row_number().over(Window.partitionBy("id").orderBy("part")) - 1
    return d.select("id", nth.alias("chunk_index"), kind.alias("memory_type"), strip(F.col("segment")).alias("document"))


#: How a dialogue's turns begin.
TURN_MARKS = (r"\buser\s*:\s*", r"\bassistant\s*:\s*", r"\bhuman\s*:\s*", r"\bai\s*:\s*", r"\b>>>\s*User\b", r"\b>>>\s*Assistant\b")


def origin(samples: DataFrame, terms: tuple[str, ...], doubtful: tuple[str, ...], floor: int = 150) -> DataFrame:
    """One row: whether samples (document) come from dialogues with an assistant, and how surely.

    Terms name assistants; doubtful ones, which also mean other things, count only beside a term or a turn. Half a term
    or two turns per thousand characters make a dialogue; a text of at least `floor` characters without any makes none;
    anything else is taken for one, with little confidence. Samples count as joined by blank lines.
    """

    def found(patterns: list[str]) -> Column:
        return F.sum(sum((F.regexp_count("document", F.lit("(?i)" + p)) for p in patterns), F.lit(0)))

    def edged(t: str) -> str:
        return (r"\b" if t[0].isalnum() else "") + re.escape(t) + (r"\b" if t[-1].isalnum() else "")

    g = samples.agg((F.sum(F.length("document")) + 2 * (F.count("document") - 1)).alias("n"), found([edged(t) for t in terms]).alias("sure"), found([edged(t) for t in doubtful]).alias("maybe"), found(list(TURN_MARKS)).alias("turns"))
    n = F.greatest(F.lit(1), F.coalesce("n", F.lit(0)))
    brands = F.coalesce("sure", F.lit(0)) + F.when((F.col("sure") > 0) | (F.col("turns") > 0), F.col("maybe")).otherwise(0)
    turns = F.coalesce("turns", F.lit(0))
    dense = (brands / (n / 1000) >= 0.5) | (turns / (n / 1000) >= 2.0)
    none = (brands == 0) & (turns == 0) & (n >= floor)
    sure = F.least(F.lit(0.95), 0.6 + 0.1 * (brands / (n / 1000) + turns / (n / 1000)))
    return g.select((dense | ~none).alias("dialogue"), F.when(dense, sure).when(none, 0.9).otherwise(0.4).alias("confidence"), brands.alias("terms"), turns.alias("turns"))
