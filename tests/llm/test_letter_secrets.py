from pyspark.sql import functions as F

from tidewatch.llm import secret_scans

VALUES = ["CorrectHorseBatteryStaple", "qWertyUiopAsdfGhjkLzxcvb", "abcdefGHIJKL", "zYxwvutSrq", "mNbvcxzLk"]


def test_letters_that_stand_apart_from_their_keyword(make_docs):
    shapes = ['password = "{}"', "token = '{}' now", "secret: {}", 'api_key ="{}"', '"passwd": "{}", go']
    rows = [(k, "near the bridge " + shape.format(v)) for k, (shape, v) in enumerate(zip(shapes, VALUES, strict=True))]
    rows += [(100 + k, f"secret: please call 555-{1000 + k} near the bridge") for k in range(40)]
    docs = make_docs(rows)
    found = secret_scans.scan(docs, F.col("source"))
    hits = {r.value for r in found.filter("is_secret").collect()}
    assert hits == set(VALUES)
    clean = secret_scans.redacted(docs, found).collect()
    assert not any(v in r.text for v in VALUES for r in clean)


def test_first_digit_far_inside_a_word(make_docs):
    long = "q" * 500 + "7"
    assert [r.value for r in secret_scans.candidates(make_docs([(1, f"see {long} there")]), F.col("lang")).collect()] == [long]


def test_plain_texts_have_no_more_candidates(make_docs):
    rows = [(1, "the secret passage near the bridge"), (2, "note: nothing assigned here"), (3, "password=hunter22 stands beside others")]
    got = secret_scans.candidates(make_docs(rows), F.col("lang")).collect()
    assert {(r.doc_id, r.value) for r in got} == {(3, "hunter22")}
