"""Table layouts. All headings are fixed values of the spreadsheets the jobs read and write."""

from __future__ import annotations

KEY = "SP ID"

# Participant export: filled down, concatenated, and taken from the first row of a record.
PARTICIPANT_FILL = ("SP ID", "Gender", "Age", "City", "State", "Nationality", "Country")
PARTICIPANT_CONCAT = (
    "Work Experience/Company", "Work Experience/Designation", "Work Experience/Tasks", "Work Experience/Industry",
    "Work Experience/From Date", "Work Experience/To Date", "Education/Qualifications",
    "Education/Institution's Name", "Education/City", "Education/Specialization", "Any Additional Skills", "Skills",
    "Computer Skills", "Languages", "Any Hobbies/Interests", "Hobbies/Interests/Type", "Hobbies/Interests/Name",
    "Interview Tags",
)
LANGUAGES = (
    "Languages", "Languages/Can read", "Languages/Can speak", "Languages/Can type", "Languages/Can write",
)
EDUCATION_AND_WORK = (
    "Education/Qualifications", "Education/Institution's Name", "Education/City", "Education/Specialization",
    "Education/Year of Passing/Graduation", "Work Experience/Company", "Work Experience/Designation",
    "Work Experience/Tasks", "Work Experience/Industry", "Work Experience/From Date", "Work Experience/To Date",
    "Any Hobbies/Interests", "Hobbies/Interests/Type", "Hobbies/Interests/Name",
)
LOCAL_VOLUNTEERING = (
    "Local Volunteering/Volunteering Duration (No. of Days)", "Local Volunteering/Local center activity",
)
QUESTION = "Interviewer Feedback/Summary/Question"
SUMMARY = "Interviewer Feedback/Summary/Summary"
COMMENTS = "Interviewer Feedback/Comments"
FEEDBACK_PICKS = {
    "Interviewer Work Experience Summary": ("Work Experience", SUMMARY),
    "Interviewer Work Experience Feedback": ("Work Experience", COMMENTS),
    "Interviewer Education Summary": ("Education (Red Flags)", SUMMARY),
    "Interviewer Education Feedback": ("Education (Red Flags)", COMMENTS),
}
CONCERNS = ("Concerns", "Please enter any concerns here", "Any highlights for SP Team")
TAIL = ("Computer Skills", "Any Additional Skills", "Skills", "Interview Tags")


def center_volunteering(center: str) -> tuple[str, ...]:
    head = f"Volunteering at {center}"
    return (head, f"{head}/Volunteering Duration (No. of Days)", f"{head}/Center Activity", f"{head}/Description")


def filled_columns(center: str) -> tuple[str, ...]:
    """Columns of the filled-down copy. `center` is the centre's name in four headings."""
    return (KEY, *LANGUAGES, *EDUCATION_AND_WORK, *center_volunteering(center), *LOCAL_VOLUNTEERING,
            QUESTION, SUMMARY, COMMENTS)


def rolled_columns(center: str, answers: tuple[str, ...] = ()) -> tuple[str, ...]:
    """Columns of the rolled-up table. `answers` are the headings of the free-text answers."""
    return (*PARTICIPANT_FILL, *LANGUAGES, *EDUCATION_AND_WORK, *center_volunteering(center), *LOCAL_VOLUNTEERING,
            QUESTION, SUMMARY, COMMENTS, *CONCERNS, *answers, *TAIL)


# Rolled-up participants as the allocation reads them.
ALLOCATION_COLUMNS = (
    "SP ID", "Work Experience/Company", "Work Experience/Designation", "Work Experience/Tasks",
    "Work Experience/Industry", "Work Experience/From Date", "Work Experience/To Date", "Education/Qualifications",
    "Education/Specialization", "Skills", "Any Additional Skills", "Computer Skills", "Languages", "Gender", "Age",
)
ALLOCATION_LISTS = (
    "Work Experience/Company", "Work Experience/Designation", "Work Experience/Tasks", "Work Experience/Industry",
    "Work Experience/From Date", "Work Experience/To Date", "Education/Qualifications", "Education/Specialization",
    "Skills", "Languages",
)
INPUT_COLUMNS = ("SP ID", "Work Experience/Designation", "Education/Qualifications", "Education/Specialization")

# Job requests.
REQUEST_KEY = "Request Name"
REQUEST_CONCAT = ("Skills/Keywords", "Educational Qualification")
REQUEST_ORDER = (
    "Request Name", "Job Title", "Job Description", "Gender Preference", "# of Volunteers", "Work Experience Needed?",
    "Number of Years", "Skills/Keywords", "Educational Qualification", "Comments",
    "Please mention any other comments about Seva timings", "Department", "Skills", "Languages",
)
REQUEST_ADDED = ("Skills", "Languages")
REQUEST_DEDUP = ("Request Name", "Job Title")
REQUEST_REQUIRED = ("Request Name", "Job Title", "Job Description", "Department")
REQUEST_LISTS = ("Languages", "Skills/Keywords", "Skills")
STATUS, OLD_LABEL, NEW_LABEL = "VRF ID Status", "Old VRF ID", "New VRF ID"
GENERIC_DESCRIPTION = "Job Title Generic Description"
NODE_METADATA = ("Job Title", "Request Name", "Department")

# Predictions.
TITLE_HEADING, REQUEST_HEADING, SCORE_HEADING = "Vec Pred Job Title", "Vec Pred Request Name", "Vec Pred Score"
RANKED = (("title", TITLE_HEADING), ("request", REQUEST_HEADING), ("score", SCORE_HEADING))
# The department text of a rank for which no job was found.
NO_DEPARTMENT = "NA:  "
DEFAULT_RESULT = {"title": "Ashram Support", "request": ""}


def prediction_triples(k: int) -> tuple[tuple[str, str, str], ...]:
    """Title, request and department columns of ranks 1 to k."""
    return tuple((f"Pred Job Title: {i}", f"Pred VRF ID: {i}", f"Department {i}") for i in range(1, k + 1))


GRADUATION = "Education/Year of Passing/Graduation"


# Tags, after four fixed columns.
TAG_FIXED = ("SP ID", "Name", "City", "Processed Date")


def tag_names(organisation: str) -> tuple[str, ...]:
    """The 23 tags; one of them names the organisation."""
    return (
        "Poornanga", "High Skill", "Tamil Speaking", "Tier City", "Medical Professional", "Volunteer Experience",
        f"{organisation} Family Connect", "English Proficiency", "Other Languages", "Prestigious Institution",
        "Undergrad/Postgrad", "Specialization", "Psychological Concerns", "Medical Concerns",
        "Highlights to SP Team", "Articulate", "General Willingness Level", "Seva Willingness Level",
        "Local Center Volunteering", "Ashram Volunteering", "Language Tags & Fluency", "Expertise / Skills",
        "Learnings from Past Seva Team Notes",
    )


# The SQL split of the participants.
STRUCTURED = ("SP ID", "Gender", "Age", "Work Experience/From Date", "Work Experience/To Date")
UNSTRUCTURED = (
    "SP ID", "Work Experience/Company", "Work Experience/Designation", "Work Experience/Tasks",
    "Work Experience/Industry", "Education/Qualifications", "Education/Specialization", "Any Additional Skills",
    "Computer Skills", "Skills", "Languages",
)
STRUCTURED_TABLE, UNSTRUCTURED_TABLE, LANGUAGE_TABLE = (
    "participants_structured", "participants_unstructured", "participants_languages",
)
