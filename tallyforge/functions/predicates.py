"""What counts as success, as column expressions over the fields of a pass.

Four definitions are in use and differ on purpose; each has its own name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_true(flag: Column | str) -> Column:
    return F.coalesce(col(flag), F.lit(False))


def is_strict_success(completed="completed", forced_stop="forced_stop") -> Column:
    """For exports: both fields are present and say so."""
    return col(completed).eqNullSafe(True) & col(forced_stop).eqNullSafe(False)


def status(completed="completed", forced_stop="forced_stop") -> Column:
    """For rows and counts: a missing forced_stop is no forced stop."""
    return F.when(is_true(completed) & ~is_true(forced_stop), "PASS").otherwise("FAIL")


def any_completed(completed="completed") -> Column:
    """For stores and merges, an aggregate: errors do not matter."""
    return F.bool_or(is_true(completed))


def is_clean_success(completed="completed", error="error") -> Column:
    """For dispatch and the best pass: completed and without an error."""
    return is_true(completed) & (F.coalesce(col(error), F.lit("")) == "")


def is_dummy_text(value: Column | str) -> Column:
    """Null or blank; 0 and false are values."""
    return col(value).isNull() | (F.trim(col(value)) == "")


def is_dummy_array(value: Column | str) -> Column:
    return col(value).isNull() | (F.size(col(value)) == 0)


def first_non_dummy(*values: Column | str) -> Column:
    """The first text that is not null or blank; if there is none, the last value."""
    return F.coalesce(*[F.when(~is_dummy_text(v), col(v)) for v in values], col(values[-1]))


def diagnosis(completed="completed", forced_stop="forced_stop", file_errors="output_file_errors") -> Column:
    """PASS, PASS* (finished, but output files failed) or FAIL."""
    flawed = F.coalesce(F.size(F.map_keys(col(file_errors))), F.lit(0)) > 0
    passed = status(completed, forced_stop) == "PASS"
    return F.when(passed & flawed, "PASS*").when(passed, "PASS").otherwise("FAIL")


def result_errors(task_id: Column | str, agent: Column | str, closed: Column | str, run: Column | str = "run") -> Column:
    """What is wrong with the struct `run`, held against the task and agent that it should be of."""
    r = col(run)
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    low = F.lower(F.coalesce(r["response_text"], F.lit("")))
    differs = lambda name, want: F.when(~r[name].eqNullSafe(col(want)), F.concat(F.lit(f"{name} mismatch: "), F.coalesce(r[name], F.lit("None")), F.lit(" != "), F.coalesce(col(want), F.lit("None"))))
    return F.array_compact(
        F.array(
            differs("task_id", task_id),
            differs("agent", agent),
            *[F.when(empty(r[f]), f"{f} is empty") for f in ("model", "response_text", "started_at", "completed_at")],
            F.when(~is_true(r["completed"]), F.concat(F.lit("completed=False (error: "), F.coalesce(r["error"], F.lit("")), F.lit(")"))),
            F.when(is_true(closed) & ~low.contains("closed") & ~low.contains("iat"), "Closed task report doesn't mention IAT/Closed status"),
        )
    )


def sorted_by(items: Column, key: str) -> Column:
    """An array of structs in the order of one field, whatever the others are."""
    return F.array_sort(items, lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0))
