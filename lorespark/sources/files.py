"""File scans and rule matching."""

from __future__ import annotations

import fnmatch
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip

# Folders and files that are never read, and text-file endings (a product's own names are left out).
SKIP = (
    ".git", "node_modules", "__pycache__", ".venv", "venv", "env", "dist", "build", ".next", "coverage", ".ruff_cache", ".mypy_cache", ".pytest_cache",
    ".cache", ".tox", ".nox", ".idea", ".vscode", ".ipynb_checkpoints", ".eggs", "htmlcov", "target",
)
SKIP_FILES = ("entities.json", ".gitignore", "package-lock.json", "pnpm-lock.yaml", "yarn.lock")
ENDINGS = (
    ".txt", ".md", ".py", ".js", ".ts", ".jsx", ".tsx", ".json", ".jsonl", ".yaml", ".yml", ".html", ".css", ".java", ".go", ".rs", ".rb", ".sh", ".csv",
    ".sql", ".toml",
)
TRANSCRIPTS = (".txt", ".md", ".json", ".jsonl")


def in_skipped_folder(path: Column, skip: tuple[str, ...] = SKIP) -> Column:
    return F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(s) for s in skip]))


def ends_with(path: Column, endings: tuple[str, ...]) -> Column:
    return path.rlike("(?i)(" + "|".join(e.replace(".", r"\.") for e in endings) + ")$")


def readable(path: Column, length: Column, rules: dict[str, list[str]] | None = None, include: tuple[str, ...] = (), most_bytes: int = 500 << 20) -> Column:
    """Whether a path below a root is read: a text file of no skipped folder or name, not too large, and not ignored by
    the rules of a folder above it ({folder: lines}; the root is ""). Paths in or below `include` are read anyway."""
    plain = ends_with(path, ENDINGS) & ~in_skipped_folder(path) & ~F.element_at(F.split(path, "/"), -1).isin(*SKIP_FILES)
    if rules:
        plain = plain & ~ignored(path, rules)
    inside = [(path == p.strip("/")) | path.startswith(p.strip("/") + "/") for p in include]
    forced = F.lit(False)
    for x in inside:
        forced = forced | x
    return (length <= most_bytes) & (plain | forced)


def ignored(path: Column, rules: dict[str, list[str]]) -> Column:
    """Whether ignore rules leave a path out: the folders' rules in order, outer ones first; the last that matches the
    path, or a folder above it, decides."""
    made = [(folder.strip("/"), IgnoreRules(lines)) for folder, lines in sorted(rules.items(), key=lambda x: x[0].count("/") + bool(x[0]))]

    def one(p: str) -> bool:
        out = False
        for folder, r in made:
            if folder and not p.startswith(folder + "/"):
                continue
            verdict = r.verdict(p[len(folder) :].strip("/"))
            out = out if verdict is None else verdict
        return out

    @F.pandas_udf("boolean")
    def run(paths: pd.Series) -> pd.Series:
        return paths.map(one)

    return run(path)


def scan(spark: SparkSession, root: str, rules: dict[str, list[str]] | None = None, include: tuple[str, ...] = (), most_bytes: int = 500 << 20) -> DataFrame:
    """(path, mtime, length, document) of the text files below a root, by Spark's own reader; paths are below the root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").removeprefix("file://")
    below = F.regexp_replace(F.regexp_replace("path", r"^file:/+", "/"), "^" + re.escape(base) + "/", "")
    files = files.withColumn("path", below)
    files = files.where(readable(F.col("path"), F.col("length"), rules, include, most_bytes))
    return files.select("path", F.unix_micros("modificationTime").alias("mtime"), "length", F.decode("content", "UTF-8").alias("document"))


def is_transcript(path: Column) -> Column:
    return ends_with(path, TRANSCRIPTS) & ~F.lower(path).endswith(".meta.json")


def scan_transcripts(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of the chat files below a root, without their metadata files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.where(is_transcript(F.col("path"))).select("path", F.decode("content", "UTF-8").alias("text"))


def session_roots(files: DataFrame, head: int = 20) -> DataFrame:
    """(project, sessions, cwd) of session files (path, text): one project per folder, its number of files, and the first
    working folder that the first lines of any of them tell."""
    project = F.try_element_at(F.split("path", "/"), F.lit(-2))
    lines = F.slice(F.split("text", "\n"), 1, head)
    told = F.get(F.filter(F.transform(lines, lambda x: F.get_json_object(x, "$.cwd")), lambda x: x.isNotNull() & (x != "")), F.lit(0))
    d = files.where(F.lower("path").endswith(".jsonl")).select(project.alias("project"), "path", told.alias("cwd"))
    return d.groupBy("project").agg(F.count(F.lit(1)).alias("sessions"), F.min_by("cwd", F.when(F.col("cwd").isNotNull(), F.col("path"))).alias("cwd"))


def manifest_name(path: Column, text: Column) -> Column:
    """The project's name that a manifest (package.json, pyproject.toml, Cargo.toml, go.mod) tells; null for others."""
    file = F.element_at(F.split(path, "/"), -1)
    section = lambda head: F.nullif(F.regexp_extract(text, rf'(?ms)^\[{head}\][^\[]*?^name\s*=\s*["\']([^"\']+)["\']', 1), F.lit(""))
    module = F.nullif(F.regexp_extract(text, r"(?m)^module\s+(\S+)", 1), F.lit(""))
    return (
        F.when(file == "package.json", F.get_json_object(text, "$.name"))
        .when(file == "pyproject.toml", F.coalesce(section("project"), section(r"tool\.poetry")))
        .when(file == "Cargo.toml", section("package"))
        .when(file == "go.mod", F.element_at(F.split(module, "/"), -1))
    )


BOTS = r"(?i)\[bot\]|\bbot\b|dependabot|renovate|github-actions"


def bot(c: Column) -> Column:
    """Whether a name or an address is that of a bot."""
    return c.rlike(BOTS)


def real_name(c: Column) -> Column:
    """Whether a name has at least two words that begin with a capital."""
    return F.size(F.filter(F.split(strip(c), r"\s+"), lambda w: w.rlike(r"^\p{Lu}"))) >= 2


def authors(commits: DataFrame, most: int = 1000) -> DataFrame:
    """(repo, author, n, place) of commits (repo, place, name, email): real people among the first `most` commits of each
    repository, most active first."""
    c = commits.where((F.col("place") <= most) & ~bot(F.col("name")) & ~F.coalesce(bot(F.col("email")), F.lit(False)) & real_name(F.col("name")))
    g = c.groupBy("repo", F.col("name").alias("author")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("repo").orderBy(F.desc("n"), "author")
    return g.withColumn("place", F.row_number().over(w))


def mine(authors: DataFrame, me: str) -> DataFrame:
    """(repo, is_mine): whether `me` is among a repository's first five authors, made a tenth of its commits, or twenty."""
    total = F.sum("n").over(Window.partitionBy("repo"))
    a = authors.withColumn("hit", (F.lower("author") == me.lower()) & ((F.col("place") <= 5) | (F.col("n") >= 0.1 * total) | (F.col("n") >= 20)))
    return a.groupBy("repo").agg(F.max("hit").alias("is_mine"))


def rooms_of_folders(paths: DataFrame, words: dict[str, tuple[str, ...]]) -> DataFrame:
    """(room, n) of files (path): rooms whose words name a folder on the path, each file once per room."""
    table = [(w, r) for r, ws in words.items() for w in (r, *ws)]
    room = F.create_map(*[F.lit(x) for wr in table for x in wr])
    parts = F.transform(F.slice(F.split(F.lower("path"), "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(0))), lambda p: F.replace(p, F.lit("-"), F.lit("_")))
    met = paths.select("path", F.explode(F.array_distinct(F.filter(F.transform(parts, lambda p: room[p]), lambda x: x.isNotNull()))).alias("room"))
    return met.groupBy("room").agg(F.count(F.lit(1)).alias("n"))


def rooms_of_files(paths: DataFrame, words: dict[str, tuple[str, ...]], least: int = 2, most: int = 6) -> DataFrame:
    """(room, n): rooms whose words stand in at least `least` file names, the most frequent `most`."""
    file = F.lower(F.element_at(F.split("path", "/"), -1))
    hit = F.array(*[F.when(F.lit(False) if not ws else F.exists(F.array(*[F.lit(w) for w in (r, *ws)]), lambda w: F.contains(file, w)), F.lit(r)) for r, ws in words.items()])
    met = paths.select(F.explode(F.filter(hit, lambda x: x.isNotNull())).alias("room"))
    return met.groupBy("room").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "room").limit(most)


class IgnoreRules:
    """Ordered ignore rules of one folder; the last rule that matches decides, `!` brings back."""

    def __init__(self, lines: list[str]):
        self.rules = []
        for line in lines:
            text = line.strip()
            if not text or text.startswith("#"):
                continue
            plain = text.startswith(("\\#", "\\!"))
            back, text = (False, text[1:]) if plain else (text.startswith("!"), text.removeprefix("!"))
            folder, text = text.endswith("/"), text.rstrip("/")
            anchored = "/" in text
            if text.lstrip("/"):
                self.rules.append((text.lstrip("/").split("/"), anchored, folder, back))

    def verdict(self, path: str, is_dir: bool = False) -> bool | None:
        """True if a path below the folder, or a folder above it, is ignored, False if it is brought back, None if no rule
        speaks of it. What lies in an ignored folder can't be brought back."""
        parts, out = path.strip("/").split("/"), None
        for n in range(1, len(parts) + 1):
            said = None
            for pattern, anchored, folder, back in self.rules:
                if folder and n == len(parts) and not is_dir:
                    continue
                if self._match(pattern, parts[:n] if anchored else parts[n - 1 : n]):
                    said = not back
            out = out if said is None else said
            if out and n < len(parts):
                return True
        return out

    def ignores(self, path: str, is_dir: bool = False) -> bool:
        return bool(self.verdict(path, is_dir))

    @classmethod
    def _match(cls, pattern: list[str], parts: list[str]) -> bool:
        if not pattern:
            return not parts
        if pattern[0] == "**":
            return any(cls._match(pattern[1:], parts[i:]) for i in range(len(parts) + 1))
        return bool(parts) and fnmatch.fnmatchcase(parts[0], pattern[0]) and cls._match(pattern[1:], parts[1:])
