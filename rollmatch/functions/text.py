"""Text rendering: lists, records, department labels and the summary templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, strip
from rollmatch.functions.dates import month_difference, parse_day


def newline_cells(value: Column) -> Column:
    """Only a cell that is exactly one newline becomes a space."""
    return F.when(value == "\n", F.lit(" ")).otherwise(value)


def newlines_to_spaces(value: Column) -> Column:
    return F.replace(value, F.lit("\n"), F.lit(" "))


def quoted_text(value: Column) -> Column:
    """A string the way a list prints it: single quotes unless it holds one and no double quote."""
    plain = value
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(raw), F.lit(shown))
    return F.when(
        F.contains(value, F.lit("'")) & ~F.contains(value, F.lit('"')),
        F.concat(F.lit('"'), plain, F.lit('"')),
    ).otherwise(F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))


def list_repr(values: Column) -> Column:
    """`['a', 'b']` for an array of strings."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, quoted_text), ", "), F.lit("]"))


def is_na_list(text: Column) -> Column:
    return strip(text) == "['NA']"


def department_label(text: Column) -> Column:
    """The trimmed part after the first colon; the text itself without one; NA when missing."""
    cut = strip(F.split(text, ":").getItem(1))
    return (
        F.when(text.isNull() | (text == "") | (F.lower(text) == "nan"), F.lit("NA"))
        .when(F.contains(text, F.lit(":")), cut)
        .otherwise(text)
    )


def record_text(names: Sequence[str]) -> Column:
    """`name: value` lines of a record, joined by a space."""
    return F.concat_ws(" ", *[
        F.concat(F.lit(f"{n}: "), F.coalesce(col(n).cast("string"), F.lit("None")), F.lit("\n")) for n in names
    ])


def experience_sentences(industries: Column, tasks: Column, starts: Column, ends: Column) -> Column:
    """One sentence per job, as many as the shortest list; months only when both dates parse."""
    shortest = F.least(F.size(industries), F.size(tasks), F.size(starts), F.size(ends))

    def sentence(row: Column) -> Column:
        months = month_difference(row["s"], row["e"])
        return F.concat(
            F.lit("A "), row["i"], F.lit(" in the industry doing "), row["t"], F.lit(" tasks"),
            F.when(months.isNotNull(), F.concat(F.lit(" for "), months.cast("string"), F.lit(" months.")))
            .otherwise(F.lit(".")),
        )

    zipped = F.arrays_zip(
        industries.alias("i"), tasks.alias("t"),
        F.transform(starts, parse_day).alias("s"), F.transform(ends, parse_day).alias("e"),
    )
    return F.transform(F.slice(zipped, F.lit(1), shortest), sentence)


def participant_summary(
    key: Column, industries: Column, tasks: Column, starts: Column, ends: Column,
    qualifications: Column, specializations: Column, skills: Column,
    extra_skills: Column, computer_skills: Column, languages: Column, gender: Column, age: Column,
) -> Column:
    jobs = F.array_join(experience_sentences(industries, tasks, starts, ends), " ")
    return F.concat(
        F.lit("\nParticipant "), key.cast("string"), F.lit(" has the following work experience: "), jobs,
        F.lit("\nThey have the following qualifications: "), list_repr(qualifications),
        F.lit(" in "), list_repr(specializations),
        F.lit(".\nThey have the following skills: "), list_repr(skills),
        F.lit(" and "), extra_skills, F.lit(" and computer skill \n"), computer_skills,
        F.lit(" and know the following languages: "), F.array_join(languages, "."),
        F.lit(".\nThe participant is a "), gender, F.lit(" and "), age, F.lit(" years old.\n"),
    )


def specific_job_summary(title: Column, description: Column, keywords: Column, skills: Column,
                         languages: Column) -> Column:
    return F.concat(
        F.lit('\n    The job titled: "'), title, F.lit('" has a description: '), description,
        F.lit(",\n    and expects the following skills: "), F.array_join(keywords, ", "),
        F.lit(", and "), F.array_join(skills, ", "),
        F.lit("\n    and know the languages: "), F.array_join(languages, ", "), F.lit(".\n    "),
    )


def generic_job_summary(title: Column, description: Column) -> Column:
    return F.concat(
        F.lit('\n    The job titled: "'), title, F.lit('" has a description: '), description, F.lit(".\n    "),
    )


def retrieval_text(key: Column, designations: Column, qualifications: Column, specializations: Column,
                   legacy_duplicate: bool = True) -> Column:
    """Search text of a participant. The designation part comes twice unless `legacy_duplicate` is off."""
    head = F.concat(
        F.lit(" Participant "), key.cast("long").cast("string"), F.lit(" worked with designations: "),
        F.array_join(F.transform(designations, lambda d: F.concat(d, F.lit(", "))), ""),
    )
    trimmed = F.concat(F.substring(head, F.lit(1), F.length(head) - 2), F.lit(". "))
    pairs = F.arrays_zip(qualifications.alias("q"), specializations.alias("s"))
    shortest = F.least(F.size(qualifications), F.size(specializations))
    education = F.array_join(F.transform(
        F.slice(pairs, F.lit(1), shortest),
        lambda p: F.concat(
            F.lit(" The participant has a "), p["q"], F.lit(" education specialized in "), p["s"], F.lit(". ")),
    ), "")
    return F.concat(head, trimmed, education) if legacy_duplicate else F.concat(trimmed, education)
