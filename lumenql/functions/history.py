"""Functions of a repository row: differences, patches, merge bases and a branch's own commits.

They run the ``git`` program where the row is processed, so the repository has to be
readable there. Arguments are commit or branch rows; a branch stands for its tip.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources import repositories as git
from .library import column, row_function


def array_type(ddl: str) -> str:
    return f"array<struct<{re.sub(r'(^|, )(\w+) ', r'\1\2:', ddl)}>>"


def _rows(ddl: str, make: Callable[..., list[tuple]], *args: Column) -> Column:
    """An array of rows from ``make(path, *args)``; nothing where an argument is null or git refuses."""
    names = _names(ddl)

    @F.pandas_udf(array_type(ddl))
    def run(*columns: pd.Series) -> pd.Series:
        def one(*values):
            if any(v is None or v is pd.NA for v in values):
                return []
            try:
                return [dict(zip(names, _plain(r, ddl))) for r in make(*values)]
            except ValueError:
                return []

        return pd.Series([one(*v) for v in zip(*columns)], dtype=object)

    return run(*args)


def _names(ddl: str) -> list[str]:
    return [c.split(" ")[0] for c in re.split(r", (?![^<]*>)", ddl)]


def _plain(row: tuple, ddl: str) -> tuple:
    """Nested rows as dictionaries, as Arrow takes them."""
    kinds = [c.split(" ", 1)[1] for c in re.split(r", (?![^<]*>)", ddl)]

    def fields(value, kind):
        names = [f.split(":")[0] for f in re.search(r"struct<(.*?)>", kind)[1].split(",")]
        return dict(zip(names, value))

    return tuple([fields(v, k) for v in x] if isinstance(x, list) else fields(x, k) if isinstance(x, tuple) else x for x, k in zip(row, kinds))


def _path(row: Column) -> Column:
    return row["WorkingDirectory"]


def revision(value: Column) -> Column:
    """The commit that a commit row or a branch row stands for: they differ by what they hold."""
    return F.coalesce(F.get_json_object(F.to_json(value), "$.Tip.Sha"), F.get_json_object(F.to_json(value), "$.Sha"))


@row_function("git", "DifferenceBetween", "DifferenceBetweenCommitAndBranch", "DifferenceBetweenBranchAndCommit")
def difference_between(row, first, second):
    return _rows(git.DIFFERENCE, git.difference_rows, _path(row), revision(first), revision(second))


@row_function("git", "DifferenceBetweenCurrentAndBranch")
def difference_from_current(row, branch):
    return _rows(git.DIFFERENCE, git.difference_rows, _path(row), F.lit("HEAD"), revision(branch))


@row_function("git", "PatchBetween")
def patch_between(row, first, second):
    return _rows(git.PATCH, git.patch_rows, _path(row), revision(first), revision(second))


def _own_commits(path: str, branch: str, exclude: bool) -> list[tuple]:
    parent = git.parent_of(path, branch)
    return git.branch_commit_rows(path, branch, parent, bool(exclude)) if parent else git.commit_rows(path, branch)


@row_function("git", "GetBranchSpecificCommits")
def branch_specific_commits(row, *args):
    """``(repository, branch, exclude the merge base)``, called on either of the two."""
    flag = F.lit(True) if len(args) < 3 else column(args[2])
    repository, branch = (args[0], args[1]) if len(args) > 1 else (row, args[0])
    return _rows(git.COMMIT, _own_commits, _path(repository), branch["CanonicalName"], flag)


@row_function("git", "FindMergeBase")
def find_merge_base(row, branch):
    """The best common ancestor of a branch and the branch that it left."""
    def make(path, name):
        parent = git.parent_of(path, name)
        sha = parent and git.git(path, "merge-base", name, parent).strip()
        return [(sha, (sha,))] if sha else []

    return F.get(_rows(git.MERGE_BASE, make, _path(row), branch["CanonicalName"]), 0)
