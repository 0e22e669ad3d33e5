import pytest
from helpers import rows
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.operators import vectors
from rollmatch.plans import allocation, database, participants, requests, sync, tags
from rollmatch.plans import layouts as L

LISTS = {
    "Work Experience/Company": ["c1", None], "Work Experience/Designation": ["cook", "clerk"],
    "Work Experience/Tasks": ["t1", "t2"], "Work Experience/Industry": ["i1", "i2"],
    "Work Experience/From Date": ["2020-1-5", "2021-01-01"], "Work Experience/To Date": ["2020-03-01", "2022-01-01"],
    "Education/Qualifications": ["BSc", None], "Education/Specialization": ["maths", None],
    "Skills": ["s/-/u", None], "Languages": ["en", "ta"],
}
SCALARS = {"SP ID": ["11", None], "Any Additional Skills": [None, None], "Computer Skills": ["typing", None],
           "Gender": ["F", None], "Age": [None, None]}


def raw(spark):
    cells = {**LISTS, **SCALARS}
    data = [(i, *[cells[c][i] for c in L.ALLOCATION_COLUMNS]) for i in (0, 1)]
    lone = [(2, *["12" if c == "SP ID" else None for c in L.ALLOCATION_COLUMNS])]
    return spark.createDataFrame(data + lone, "`_ord` int, " + ", ".join(f"`{c}` string" for c in L.ALLOCATION_COLUMNS))


def test_participant_frame(spark):
    frame = {r["SP ID"]: r for r in participants.participant_frame(raw(spark)).collect()}
    one = frame[11]
    assert one["Years of Experience"] == [0.15, 1.0] and one["Skills"] == ["s", "u"] and one["Age"] == "NA"
    assert one["summary"] == (
        "\nParticipant 11 has the following work experience: A i1 in the industry doing t1 tasks for 2 months. "
        "A i2 in the industry doing t2 tasks for 12 months.\n"
        "They have the following qualifications: ['BSc'] in ['maths'].\n"
        "They have the following skills: ['s', 'u'] and NA and computer skill \ntyping and know the following languages: "
        "en.ta.\nThe participant is a F and NA years old.\n")
    assert frame[12]["Years of Experience"] is None and frame[12]["Work Experience/From Date"] == ["NA"]


def test_allocation_to_ranked_rows(spark):
    frame = participants.participant_frame(raw(spark))
    inputs = allocation.retrieval_input(frame).withColumn("v", F.array(F.lit(1.0), F.lit(0.0)))
    nodes = spark.createDataFrame(
        [("0", "Researcher", "r0", "Lab", [1.0, 0.1]), ("1", "Cook", "r1", "Kitchen", [1.0, 1.0])],
        "id string, `Job Title` string, `Request Name` string, Department string, v array<double>")
    jobs = nodes.select(F.col("id").cast("int").alias("_ord"), "Job Title", "Department")
    wide = allocation.allocate(inputs, nodes, jobs, "v")
    got = {r["SP ID"]: r for r in wide.collect()}
    assert [got[11][f"Vec Pred Job Title: {i}"] for i in (1, 2, 3)] == ["Researcher", "Cook", "NA"]
    assert [got[11][f"Department {i}"] for i in (1, 2, 3)] == ["Researcher: Lab ", "Cook: Kitchen ", "NA:  "]
    assert [got[12][f"Vec Pred Job Title: {i}"] for i in (1, 2, 3)] == ["Ashram Support"] * 3
    people = spark.createDataFrame([("11", "en", "2024")], f"`SP ID` string, Languages string, `{L.GRADUATION}` string")
    enriched = allocation.enrich_results(wide, people)
    at = enriched.columns.index("Department 1")
    assert enriched.columns[at - 1] == "Languages" and enriched.columns[at + 3] == L.GRADUATION
    final = allocation.format_predictions(allocation.tweak_predictions(allocation.to_predictions(enriched)))
    assert [tuple(r) for r in final.collect()] == [
        ("11", "Researcher", "r0", "Lab", 1), ("11", "Cook", "r1", "Kitchen", 2),
        ("12", "Ashram Support", "", "", 1), ("12", "Ashram Support", "", "", 2), ("12", "Ashram Support", "", "", 3)]


def test_sampling_of_inputs(spark):
    frame = participants.participant_frame(raw(spark))
    assert rows(allocation.retrieval_input(frame, 1), "SP ID") == [(11,)]
    assert allocation.retrieval_input(frame, 1, random=True).count() == 1


def request_rows(spark, data):
    return spark.createDataFrame(data, "_ord int, `Request Name` string, `Job Title` string, `Job Description` string, "
                                       "Department string, `Skills/Keywords` string, Skills string, Languages string")


def test_requests_from_cleaning_to_vectors(spark):
    raw_rows = request_rows(spark, [(0, "R1", "Cook", "boil", "Kitchen", "a", None, "en"), (1, None, None, None, None, "b", None, None),
                                    (2, "R2", "Clerk", None, "Office", "NA", None, None)])
    clean = requests.clean_requests(raw_rows)
    assert rows(clean, "Request Name", "Skills/Keywords") == [("R1", "a,b"), ("R2", "")]
    generic = spark.createDataFrame([(0, "Gardener", "digs"), (1, None, "nobody")],
                                    f"_ord int, `Job Title` string, `{L.GENERIC_DESCRIPTION}` string")
    texts = requests.job_texts(raw_rows.where("_ord <> 1"), generic)
    nodes = {r["id"]: r for r in requests.index_nodes(texts).collect()}
    # The job without a title has no text: its number stays unused.
    assert {i: n["Job Title"] for i, n in nodes.items()} == {"0": "Cook", "1": "Clerk", "2": "Gardener"}
    assert nodes["2"]["text"] == '\n    The job titled: "Gardener" has a description: digs.\n    '
    assert nodes["0"]["text"] == ('\n    The job titled: "Cook" has a description: boil,\n    and expects the following skills: '
                                  "a, and NA\n    and know the languages: en.\n    ")
    assert len(nodes["0"]["embedding"]) == 256


def test_generic_rows_stay_out_of_requests_unless_legacy(spark):
    rows_in = request_rows(spark, [(0, "R1", "Cook", "boil", "Kitchen", "a", "s", "en"), (1, None, "Gardener", None, None, "z", None, None)])
    generic = spark.createDataFrame([], f"_ord int, `Job Title` string, `{L.GENERIC_DESCRIPTION}` string")
    plain, legacy = (requests.job_texts(rows_in, generic, legacy=flag).first()["summary"] for flag in (False, True))
    assert "skills: a, and s" in plain and "skills: a, z, and s" in legacy


def test_reconcile_requests(spark):
    def t(data):
        return spark.createDataFrame(data, "_ord int, `Request Name` string, v string")

    to_append, merged, main = requests.reconcile_requests(
        t([(0, "R2", "dup"), (1, "R3", "fresh")]), t([(0, "R1", "new"), (5, "R2", "new")]), t([(9, "R1", "old"), (3, "R0", "old")]),
        t([(0, " R3 ", "main"), (1, "R9", "main")]).drop("_ord"))
    assert rows(to_append, "Request Name") == [("R3",)]
    assert rows(merged, "Request Name", "v", L.STATUS) == [
        ("R0", "old", "Old VRF ID"), ("R1", "new", "New VRF ID"), ("R2", "new", "New VRF ID"), ("R3", "fresh", "New VRF ID")]
    assert rows(main, "Request Name", "v") == [("R0", "old"), ("R1", "new"), ("R2", "new"), ("R3", "fresh"), ("R9", "main")]


def test_combine_requests(spark):
    new = spark.createDataFrame([(0, "R1", "Cook", "n")], "_ord int, `Request Name` string, `Job Title` string, v string")
    old = spark.createDataFrame([(0, "R1", "Cook", "o"), (1, "R1", "Clerk", "o")], new.schema)
    generic = spark.createDataFrame([(0, "Cook", "g"), (1, "Cook", "h")], "_ord int, `Job Title` string, v string")
    assert rows(requests.combine_requests(new, old, generic), "Request Name", "Job Title", "v") == [
        ("R1", "Clerk", "o"), ("R1", "Cook", "o"), (None, "Cook", "h")]


def test_tags(spark):
    people = spark.createDataFrame([("1", "", "Full", "X"), ("2", "Ann", "B", None), ("3", None, "Call lost", "Z")],
                                   "`SP ID` string, `First Name` string, Name string, City string")
    replies = spark.createDataFrame([("1", 'ok {"Poornanga": "yes", "Extra": "no"}'), ("2", "nothing")], "`SP ID` string, reply string")
    names = L.tag_names("Our")
    assert len(names) == 23
    got = {r["SP ID"]: r for r in tags.tag_records(people, replies, names).collect()}
    assert got["1"]["Poornanga"] == "yes" and got["1"]["High Skill"] == "No info found" and got["1"]["Name"] == "Full"
    assert got["2"]["Name"] == "Ann" and got["2"]["City"] == "" and got["2"]["Poornanga"] == "No info found"
    assert got["3"]["Name"] == "" and got["3"]["Poornanga"] == "Processing failed"
    assert tags.tag_records(people, replies, names).columns == [*L.TAG_FIXED, *names]


def test_database(spark):
    database.publish_participants(participants.participant_frame(raw(spark)))
    got = spark.sql("SELECT `SP ID`, Age, `Work Experience/To Date` AS e FROM participants_structured")
    assert rows(got) == [(11, "NA", "2020-03-01"), (11, "NA", "2022-01-01"), (12, "NA", "NA")]
    assert rows(spark.table("participants_languages")) == [(11, "en"), (11, "ta"), (12, "NA")]
    texts = database.search_texts(spark.table("participants_unstructured").where(col("SP ID") == 11)).first()["text"]
    assert texts.startswith("Work Experience/Company: c1\n Work Experience/Designation: cook, clerk\n")


def test_syncs_are_idempotent(spark):
    source = spark.createDataFrame([("1", "a"), ("2", None)], "`SP ID` string, v string")
    target = spark.createDataFrame([("1", "a")], "`SP ID` string, v string")
    for job in (sync.sync_filled, sync.sync_participants, sync.sync_predictions):
        added, report = job(source, target)
        assert rows(added) == [("2", None)]
        assert report.first()["rows_after"] == 2
        again, _ = job(source, target.unionByName(added))
        assert again.count() == 0


@pytest.mark.parametrize("k", [1, 5])
def test_every_rank_is_formatted(spark, k):
    inputs = allocation.retrieval_input(participants.participant_frame(raw(spark))).withColumn("v", F.array(F.lit(1.0), F.lit(0.0)))
    nodes = spark.createDataFrame([(str(i), f"job {i}", f"r{i}", f"d{i}", [1.0, i / 10]) for i in range(6)],
                                  "id string, `Job Title` string, `Request Name` string, Department string, v array<double>")
    wide = allocation.allocate(inputs, nodes, nodes.select(F.col("id").cast("int").alias("_ord"), "Job Title", "Department"), "v", k)
    people = spark.createDataFrame([("11", "en", "2024")], f"`SP ID` string, Languages string, `{L.GRADUATION}` string")
    made = allocation.to_predictions(allocation.enrich_results(wide, people, k), k=k)
    got = allocation.format_predictions(made, k).where("`SP ID` = '11'").collect()
    assert [tuple(r)[1:] for r in got] == [(f"job {i}", f"r{i}", f"d{i}", i + 1) for i in range(k)]


def test_first_inputs_in_row_order(spark):
    rows_ = raw(spark).withColumn("_ord", 10 - F.col("_ord"))
    frame = participants.participant_frame(rows_, keep_order=True)
    first = allocation.retrieval_input(frame, 1).collect()
    assert [r["SP ID"] for r in first] == [12] and allocation.ORDER not in first[0].asDict()


def test_requests_job_indexes_what_it_combines(spark, tmp_path):
    shape = "_ord int, `Request Name` string, `Job Title` string, `Job Description` string, Department string, " \
            "`Skills/Keywords` string, Skills string, Languages string"
    new = spark.createDataFrame([(1, "r1", "cook", "cooks", "kitchen", "knives", "soup", "en")], shape)
    old = spark.createDataFrame([(1, "r0", "clerk", "files", "office", "order", None, "ta"),
                                 (2, "r1", "cook", "older text", "kitchen", "x", None, "en")], shape)
    clean = spark.createDataFrame([(1, "r2", "guard", "guards", "gate", "calm", None, "en")], shape)
    main = spark.createDataFrame([("r9", "left over")], "`Request Name` string, `Job Title` string")
    generic = spark.createDataFrame([(1, "helper", "helps")], f"_ord int, `Job Title` string, `{L.GENERIC_DESCRIPTION}` string")
    out = requests.requests_job(clean, new, old, main, generic, str(tmp_path / "vectors"))
    assert [r["Request Name"] for r in out["to_append"].collect()] == ["r2"]
    assert sorted(r["Request Name"] for r in out["merged"].collect()) == ["r0", "r1", "r2"]
    assert sorted(r["Request Name"] for r in out["main"].collect()) == ["r0", "r1", "r2", "r9"]
    nodes = {r["Job Title"]: r for r in out["nodes"].collect()}
    assert set(nodes) == {"cook", "clerk", "helper"} and "older text" in nodes["cook"]["text"]
    assert all(len(r["embedding"]) == 256 for r in nodes.values())


def test_every_query_row_is_answered(spark):
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, None)], "k int, v array<double>")
    nodes = spark.createDataFrame([("a", [1.0, 0.0], "right"), ("b", [0.0, 1.0], "up")], "id string, v array<double>, title string")
    got = vectors.retrieve_jobs(asked, nodes, 1, "k", "v", "id", {"t": "title"}, default={"t": "none"})
    assert rows(got, "k", "t") == [(1, "right"), (1, "up"), (2, "right"), (3, "none")]
    plain = vectors.retrieve_jobs(asked, nodes, 1, "k", "v", "id", {"t": "title"})
    assert rows(plain, "k", "t") == [(1, "right"), (1, "up"), (2, "right")]


def test_search_texts_meet_the_corpus_in_its_own_weights(spark):
    jobs = spark.createDataFrame([(1, "cook soup"), (2, "guard gate"), (3, "cook rice")], "id int, t string")
    people = spark.createDataFrame([(7, "can guard a gate"), (8, "nothing known")], "id int, t string")
    fitted = vectors.fit_terms(jobs, "id", "t")
    weights = {(r["id"], r["term"]): r["weight"] for r in vectors.weigh_terms(people, "id", "t", fitted).collect()}
    own = {(r["id"], r["term"]): r["weight"] for r in vectors.term_weights(jobs, "id", "t").collect()}
    assert weights == {(7, "guard"): own[2, "guard"], (7, "gate"): own[2, "gate"]}
    near = vectors.nearest(vectors.embed_text(people, "id", "t", 64, fitted), vectors.embed_text(jobs, "id", "t", 64), 1,
                           "id", "embedding", "id", "embedding")
    assert [(r["id"], r["near_id"]) for r in near.collect()] == [(7, 2)]
