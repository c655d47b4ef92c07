"""Version-control history, read through the ``git`` program of the driver.

History is metadata: one pass of ``git log`` streams it, and the result is a local table.
Repositories are read where the driver can see them; parents are ids, so histories join
rather than nest.
"""

from __future__ import annotations

import os
import re
import subprocess
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Registry, TableFunction

COMMIT = "Sha string, Message string, MessageShort string, Author string, AuthorEmail string, Committer string, CommitterEmail string, CommittedWhen timestamp, Parents array<struct<Sha:string>>"
BRANCH = "FriendlyName string, CanonicalName string, IsRemote boolean, IsTracking boolean, IsCurrentRepositoryHead boolean, UpstreamBranchCanonicalName string, RemoteName string, Tip struct<Sha:string>, TrackedBranch struct<FriendlyName:string,CanonicalName:string>, BranchTrackingDetails struct<AheadBy:int,BehindBy:int>"
TAG = "FriendlyName string, CanonicalName string, Message string, IsAnnotated boolean, Annotation struct<Message:string,Name:string,Sha:string,Tagger:struct<Name:string,Email:string,WhenSigned:timestamp>>, Commit struct<Sha:string>"
STASH = "Message:string,Base:struct<Sha:string>,Index:struct<Sha:string>,UntrackedFiles:struct<Sha:string>,WorkTree:struct<Sha:string>"
INFORMATION = "Path:string,WorkingDirectory:string,IsBare:boolean,IsShallow:boolean,IsHeadDetached:boolean,IsHeadUnborn:boolean"
HISTORY = "CommitSha string, Author string, AuthorEmail string, CommittedWhen timestamp, FilePath string, ChangeType string, OldPath string"
HUNK = "StartLineNumber int, EndLineNumber int, LineCount int, CommitSha string, Author string, AuthorEmail string, AuthorDate timestamp, Committer string, CommitterEmail string, CommitterDate timestamp, Summary string, OriginalStartLineNumber int, OriginalFilePath string, Lines array<struct<LineNumber:int,Content:string>>"
_CHANGES = {"A": "Added", "M": "Modified", "D": "Deleted", "R": "Renamed", "C": "Copied", "T": "TypeChanged"}
_STATES = {"?": "NewInWorkdir", "A": "NewInIndex", "M": "Modified", "D": "Deleted", "R": "Renamed", "U": "Conflicted", "!": "Ignored", " ": "Unaltered"}


def git(path: str, *args: str) -> str:
    env = os.environ | {"GIT_OPTIONAL_LOCKS": "0", "LC_ALL": "C"}
    done = subprocess.run(["git", "-c", "safe.directory=*", "-c", "core.quotePath=false", "-C", path, *args], capture_output=True, env=env)
    if done.returncode:
        raise ValueError(f"git {args[0]} failed: {done.stderr.decode(errors='replace').strip()}")
    return done.stdout.decode("utf-8", "replace")


def _when(seconds: str) -> datetime:
    return datetime.fromtimestamp(int(seconds))


def commit_rows(path: str, *revisions: str) -> list[tuple]:
    out = git(path, "log", "--format=%H%x1f%B%x1f%s%x1f%an%x1f%ae%x1f%cn%x1f%ce%x1f%ct%x1f%P%x1e", *(revisions or ("--all",)))
    rows = []
    for record in filter(None, (r.strip("\n") for r in out.split("\x1e"))):
        sha, body, short, *people, when, parents = record.split("\x1f")
        rows.append((sha, body.rstrip("\n") + "\n", short, *people, _when(when), [(p,) for p in parents.split()]))
    return rows


def commits(engine, path: str) -> DataFrame:
    return engine.spark.createDataFrame(commit_rows(path, "HEAD"), COMMIT)


def branch_rows(path: str) -> list[tuple]:
    form = "%(refname)%1f%(refname:short)%1f%(objectname)%1f%(HEAD)%1f%(upstream)%1f%(upstream:remotename)%1f%(upstream:short)%1f%(upstream:track,nobracket)"
    rows = []
    for line in git(path, "for-each-ref", f"--format={form}", "refs/heads", "refs/remotes").splitlines():
        full, short, tip, head, upstream, remote, near, track = line.split("\x1f")
        steps = {word: int(n) for word, n in re.findall(r"(ahead|behind) (\d+)", track)}
        gone = not upstream or track == "gone"
        tracked = (None, None) if gone else (steps.get("ahead", 0), steps.get("behind", 0))
        rows.append((short, full, full.startswith("refs/remotes/"), bool(upstream), head == "*", upstream or None, remote or None, (tip,), (near, upstream) if upstream else None, tracked))
    return rows


def branches(engine, path: str) -> DataFrame:
    df = engine.spark.createDataFrame(branch_rows(path), BRANCH)
    tips = engine.spark.createDataFrame(commit_rows(path), COMMIT).select(F.col("Sha").alias("__sha"), F.struct(*[c.split(" ")[0] for c in COMMIT.split(", ")]).alias("__tip"))
    return df.join(tips, F.col("Tip.Sha") == F.col("__sha"), "left").withColumn("Tip", F.col("__tip")).drop("__sha", "__tip")


def tag_rows(path: str) -> list[tuple]:
    form = "%(refname:short)%1f%(refname)%1f%(contents:subject)%1f%(objecttype)%1f%(taggername)%1f%(taggeremail:trim)%1f%(taggerdate:unix)%1f%(objectname)%1f%(*objectname)"
    rows = []
    for line in git(path, "for-each-ref", f"--format={form}", "refs/tags").splitlines():
        short, full, message, kind, tagger, email, when, own, peeled = line.split("\x1f")
        annotated = kind == "tag"
        rows.append((short, full, message if annotated else None, annotated, (message, short, own, (tagger, email, _when(when)) if when else None) if annotated else None, (peeled if annotated else own,)))
    return rows


def tags(engine, path: str) -> DataFrame:
    return engine.spark.createDataFrame(tag_rows(path), TAG)


def stash_rows(path: str) -> list[tuple]:
    out = git(path, "stash", "list", "--format=%gd%x1f%H%x1f%gs%x1f%P").splitlines()
    rows = []
    for line in out:
        name, sha, message, parents = line.split("\x1f")
        base, *rest = parents.split()
        rows.append((message, (base,), (rest[0],) if rest else None, (rest[1],) if len(rest) > 1 else None, (sha,)))
    return rows


def information(path: str) -> tuple:
    """Facts of the repository: bare, shallow, detached, unborn, the paths of it and of its files."""
    flag = lambda *args: git(path, *args).strip() == "true"
    head = subprocess.run(["git", "-c", "safe.directory=*", "-C", path, "symbolic-ref", "-q", "HEAD"], capture_output=True)
    born = subprocess.run(["git", "-c", "safe.directory=*", "-C", path, "rev-parse", "-q", "--verify", "HEAD"], capture_output=True)
    inside = None if flag("rev-parse", "--is-bare-repository") else git(path, "rev-parse", "--show-toplevel").strip() + "/"
    return (git(path, "rev-parse", "--absolute-git-dir").strip() + "/", inside, inside is None, flag("rev-parse", "--is-shallow-repository"), head.returncode != 0, born.returncode != 0)


def file_history(engine, path: str, pattern: str, skip: int | None = None, take: int | None = None) -> DataFrame:
    """Changes of the files that a wildcard names, newest first; a negative ``take`` starts from the oldest."""
    out = git(path, "log", "--format=%x1e%H%x1f%an%x1f%ae%x1f%ct", "--name-status", "-M", "HEAD", "--", f":(glob){pattern}" if "*" in pattern else pattern)
    rows = []
    for record in filter(None, out.split("\x1e")):
        head, *changes = record.strip("\n").split("\n")
        sha, author, email, when = head.split("\x1f")
        for change in filter(None, changes):
            kind, *names = change.split("\t")
            rows.append((sha, author, email, _when(when), names[-1], _CHANGES.get(kind[0], kind), names[0] if len(names) > 1 else None))
    if take is not None and take < 0:
        rows, take = rows[::-1], -take
    begin = skip or 0
    return engine.spark.createDataFrame(rows[begin : None if take is None else begin + take], HISTORY)


def status(engine, path: str) -> DataFrame:
    rows = []
    for line in git(path, "status", "--porcelain", "--untracked-files=all").splitlines():
        index, work, name = line[0], line[1], line[3:]
        main = index if index not in " ?" else work
        rows.append((name, _STATES.get(main, main), _STATES.get(index, index), _STATES.get(work, work)))
    return engine.spark.createDataFrame(rows, "FilePath string, State string, IndexStatus string, WorkDirStatus string")


def remotes(engine, path: str) -> DataFrame:
    rows = [(n, git(path, "remote", "get-url", n).strip(), git(path, "remote", "get-url", "--push", n).strip()) for n in git(path, "remote").split()]
    return engine.spark.createDataFrame(rows, "Name string, Url string, PushUrl string")


def blame(engine, path: str, file: str, revision: str = "HEAD") -> DataFrame:
    """Spans of lines by the commit that last changed them."""
    about: dict[str, dict[str, str]] = {}
    lines: list[tuple[str, int, int, str, str]] = []
    sha = ""
    original = final = 0
    for line in git(path, "blame", "--porcelain", revision, "--", file).split("\n"):
        head = re.match(r"^([0-9a-f]{40}) (\d+) (\d+)", line)
        if head:
            sha, original, final = head[1], int(head[2]), int(head[3])
            about.setdefault(sha, {})
        elif line.startswith("\t"):
            lines.append((sha, original, final, line[1:], about[sha].get("filename", file)))
        elif line:
            key, _, value = line.partition(" ")
            about[sha][key] = value
    rows, at = [], 0
    while at < len(lines):
        end = at
        while end < len(lines) and lines[end][0] == lines[at][0] and lines[end][1] - lines[at][1] == end - at:
            end += 1
        sha, original, final, _, name = lines[at]
        a = about[sha]
        mail = lambda k: a.get(k, "").strip("<>")  # noqa: E731, B023
        rows.append((final, final + end - at - 1, end - at, sha, a.get("author"), mail("author-mail"), _when(a["author-time"]), a.get("committer"), mail("committer-mail"), _when(a["committer-time"]), a.get("summary"), original, name, [(x[2], x[3]) for x in lines[at:end]]))
        at = end
    return engine.spark.createDataFrame(rows, HUNK)


def repository(engine, path: str) -> DataFrame:
    root = git(path, "rev-parse", "--show-toplevel").strip() or path
    config = []
    for line in git(path, "config", "--list", "--show-scope").splitlines():
        level, _, setting = line.partition("\t")
        key, _, value = setting.partition("=")
        config.append((key, value, level.capitalize()))
    commit = f"array<struct<{re.sub(r'(^|, )(\w+) ', r'\1\2:', COMMIT)}>>"
    branch = re.sub(r"(^|, )(\w+) ", r"\1\2:", BRANCH)
    tag = re.sub(r"(^|, )(\w+) ", r"\1\2:", TAG)
    rows = branch_rows(path)
    head = next((b for b in rows if b[4]), None)
    ddl = f"Path string, WorkingDirectory string, Branches array<struct<{branch}>>, Commits {commit}, Head struct<{branch}>, Configuration array<struct<Key:string,Value:string,ConfigurationLevel:string>>, Tags array<struct<{tag}>>, Stashes array<struct<{STASH}>>, Information struct<{INFORMATION}>"
    return engine.spark.createDataFrame([(root + "/.git/", root + "/", rows, commit_rows(path), head, config, tag_rows(path), stash_rows(path), information(path))], ddl)


MERGE_BASE = "Sha string, MergeBaseCommit struct<Sha:string>"


def merge_base(engine, path: str, first: str, second: str) -> DataFrame:
    sha = git(path, "merge-base", first, second).strip()
    return engine.spark.createDataFrame([(sha, (sha,))], MERGE_BASE)


DIFFERENCE = "OldPath string, ChangeKind string, Path string, OldSha string, NewSha string, Exists boolean, OldMode string, NewMode string, OldContent string, OldContentBytes binary, NewContent string, NewContentBytes binary"
PATCH = "LinesAdded int, LinesDeleted int, Content string, Changes array<struct<Path:string,LinesAdded:int,LinesDeleted:int,Content:string,OldMode:string,Mode:string,IsBinaryComparison:boolean>>"


def _raw_changes(path: str, first: str, second: str) -> list[tuple[str, ...]]:
    """Changed files of two revisions: kind, old and new path, modes and content ids."""
    rows = []
    for line in git(path, "diff", "--raw", "--no-abbrev", "-M", first, second).splitlines():
        head, *names = line.split("\t")
        mode, other, old, new, kind = head[1:].split(" ")
        rows.append((_CHANGES.get(kind[0], kind), names[0], names[-1], mode, other, old, new))
    return rows


def blobs(path: str, shas: list[str]) -> dict[str, bytes]:
    """Contents by id, from one process; the id of nothing has none."""
    wanted = [s for s in dict.fromkeys(shas) if s.strip("0")]
    if not wanted:
        return {}
    done = subprocess.run(["git", "-c", "safe.directory=*", "-C", path, "cat-file", "--batch"], input="\n".join(wanted).encode() + b"\n", capture_output=True)
    out, at = {}, 0
    for sha in wanted:
        end = done.stdout.index(b"\n", at)
        head = done.stdout[at:end].split(b" ")
        at = end + 1
        if head[-1] != b"missing":
            size = int(head[2])
            out[sha] = done.stdout[at : at + size]
            at += size + 1
    return out


def _text(data: bytes | None) -> str | None:
    return None if data is None or b"\0" in data[:8000] else data.decode("utf-8", "replace")


def difference_rows(path: str, first: str, second: str) -> list[tuple]:
    changes = _raw_changes(path, first, second)
    held = blobs(path, [sha for c in changes for sha in c[5:]])
    rows = []
    for kind, before, after, mode, other, old, new in changes:
        was, now = held.get(old), held.get(new)
        rows.append((before, kind, after, old, new, kind != "Deleted", mode, other, _text(was), was, _text(now), now))
    return rows


def difference(engine, path: str, first: str, second: str) -> DataFrame:
    """Changed files between two revisions, with the contents' ids on both sides."""
    return engine.spark.createDataFrame(difference_rows(path, first, second), DIFFERENCE)


def patch_rows(path: str, first: str, second: str) -> list[tuple]:
    numbers = [line.split("\t") for line in git(path, "diff", "--no-renames", "--numstat", first, second).splitlines()]
    lines = {n[2]: tuple(int(x) if x.isdigit() else None for x in n[:2]) for n in numbers}
    whole = git(path, "diff", "--no-renames", first, second)
    parts = re.split(r"^(?=diff --git )", whole, flags=re.M)[1:]
    changes = []
    raw = [line.split("\t") for line in git(path, "diff", "--no-renames", "--raw", "--no-abbrev", first, second).splitlines()]
    for (head, name), part in zip(raw, parts):
        added, deleted = lines.get(name, (0, 0))
        mode, other = head[1:].split(" ")[:2]
        changes.append((name, added or 0, deleted or 0, part, mode, other, added is None))
    return [(sum(c[1] for c in changes), sum(c[2] for c in changes), whole, changes)]


def patch(engine, path: str, first: str, second: str) -> DataFrame:
    return engine.spark.createDataFrame(patch_rows(path, first, second), PATCH)


def parent_of(path: str, branch: str) -> str | None:
    """The local branch with the fewest commits of ``branch`` since their merge base."""
    best = None
    for name, full, remote, *_ in branch_rows(path):
        if remote or name == branch or full == branch:
            continue
        base = git(path, "merge-base", branch, full).strip()
        ahead = int(git(path, "rev-list", "--count", f"{base}..{branch}"))
        if best is None or ahead < best[0]:
            best = (ahead, full)
    return best[1] if best else None


def branch_commit_rows(path: str, branch: str, parent: str, exclude_base: bool = True) -> list[tuple]:
    rows = commit_rows(path, branch, f"^{parent}")
    if not exclude_base:
        rows += commit_rows(path, "-1", git(path, "merge-base", branch, parent).strip())
    return rows


def branch_commits(engine, path: str, branch: str, parent: str, exclude_base: bool = True) -> DataFrame:
    """Commits of a branch that its parent does not reach, with the merge base itself unless excluded."""
    return engine.spark.createDataFrame(branch_commit_rows(path, branch, parent, exclude_base), COMMIT)


def register(registry: Registry) -> None:
    add = lambda name, params, make: registry.add(TableFunction("git", name, tuple(params), make))
    one = ("path: string",)
    for name, make in (("repository", repository), ("tags", tags), ("commits", commits), ("branches", branches), ("status", status), ("remotes", remotes)):
        add(name, one, make)
    pattern = (*one, "filePattern: string")
    add("filehistory", pattern, file_history)
    add("filehistory", (*pattern, "take: int"), lambda engine, path, p, take: file_history(engine, path, p, None, take))
    add("filehistory", (*pattern, "skip: int", "take: int"), file_history)
    add("blame", ("repositoryPath: string", "filePath: string"), blame)
    add("blame", ("repositoryPath: string", "filePath: string", "revision: string"), blame)
    pair = (*one, "first: string", "second: string")
    add("mergebase", pair, merge_base)
    add("differencebetween", pair, difference)
    add("patchbetween", pair, patch)
    add("branchcommits", (*one, "branch: string", "parent: string"), branch_commits)
    add("branchcommits", (*one, "branch: string", "parent: string", "excludeMergeBase: bool"), branch_commits)
