"""Participant roll-up, id mapping and the allocation input frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rollmatch.functions.columns import col, cols
from rollmatch.functions.dates import repair_date_lists, years_between_lists
from rollmatch.functions.text import participant_summary
from rollmatch.operators.lookup import enrich
from rollmatch.operators.order import ORDER, fill_down
from rollmatch.operators.rollup import fill_records, last_answers, roll_up_lists, roll_up_text
from rollmatch.operators.schema import require, select_exact
from rollmatch.plans import layouts as L
from rollmatch.session import cut, short_methods


def rolled_participants(export: DataFrame, center: str, answers: Sequence[str] = (), include_feedback: bool = False,
                        order: str = ORDER) -> DataFrame:
    """One row per participant from the multi-row export; nothing is written on the way."""
    layout = L.rolled_columns(center, tuple(answers))
    require(export, layout)
    filled = fill_down(export.select(col(order), *cols(layout)), L.PARTICIPANT_FILL, order)
    return _rolled(filled, layout, include_feedback, order)


def filled_rows(export: DataFrame, center: str, order: str = ORDER) -> DataFrame:
    """The filled-down copy without exact duplicates."""
    layout = L.filled_columns(center)
    require(export, layout)
    needed = dict.fromkeys([*layout, *[c for c in L.PARTICIPANT_FILL if c in export.columns]])
    filled = fill_down(export.select(col(order), *cols(needed)), L.PARTICIPANT_FILL, order)
    return fill_records(filled.select(col(order), *cols(layout)), L.KEY, order)


def _rolled(filled: DataFrame, layout: Sequence[str], include_feedback: bool, order: str) -> DataFrame:
    feedback = last_answers(L.QUESTION, L.FEEDBACK_PICKS, order) if include_feedback else None
    return roll_up_text(filled, (), L.PARTICIPANT_CONCAT, layout, L.KEY, order, feedback=feedback)


def roll_up_participants(
    export: DataFrame, center: str, answers: Sequence[str] = (), include_feedback: bool = False, order: str = ORDER,
) -> tuple[DataFrame, DataFrame]:
    """(one row per participant, filled-down copy without exact duplicates): the filled table, which both read, is written."""
    rolled_layout = L.rolled_columns(center, tuple(answers))
    filled_layout = L.filled_columns(center)
    require(export, [*rolled_layout, *filled_layout])
    narrow = export.select(col(order), *cols(dict.fromkeys([*rolled_layout, *filled_layout])))
    with short_methods(export.sparkSession):
        filled = cut(fill_down(narrow, L.PARTICIPANT_FILL, order))
    copy = fill_records(filled.select(col(order), *cols(filled_layout)), L.KEY, order)
    return _rolled(filled, rolled_layout, include_feedback, order), copy


def map_ids(rolled: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attach person id and name behind the key; blanks where the mapping lacks the key."""
    added = ["Person Id", "Name"]
    joined = enrich(rolled, mapping, L.KEY, added, fill="")
    return select_exact(joined, [L.KEY, *added, *[c for c in rolled.columns if c != L.KEY]])


def participant_frame(raw: DataFrame, order: str = ORDER, keep_order: bool = False) -> DataFrame:
    """Typed participants: lists rolled up, date lists repaired, years per job, summary text; on request with the order
    of each one's first row."""
    narrow = raw.select(col(order), *cols(L.ALLOCATION_COLUMNS))
    fill = [c for c in L.ALLOCATION_COLUMNS if c not in L.ALLOCATION_LISTS]
    rolled = roll_up_lists(narrow, fill, L.ALLOCATION_LISTS, L.KEY, order, keep_order=keep_order)
    start, end = "Work Experience/From Date", "Work Experience/To Date"
    starts, ends = repair_date_lists(col(start), col(end))
    repaired = rolled.withColumns({L.KEY: col(L.KEY).cast("long"), start: starts, end: ends})
    return repaired.select(
        *([col(order)] if keep_order else []), *cols(fill), *cols(L.ALLOCATION_LISTS),
        years_between_lists(col(start), col(end)).alias("Years of Experience"),
        participant_summary(
            col(L.KEY), col("Work Experience/Industry"), col("Work Experience/Tasks"), col(start), col(end),
            col("Education/Qualifications"), col("Education/Specialization"), col("Skills"),
            col("Any Additional Skills"), col("Computer Skills"), col("Languages"), col("Gender"), col("Age"),
        ).alias("summary"))


