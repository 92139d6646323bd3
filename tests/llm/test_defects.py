import pytest
from pyspark.sql import functions as F

from siltworks.llm.defects import flag_defects, is_copy, is_empty, is_refusal

FILL = [(100 + i, f"What does `a_b{i}` do?", f"It keeps the old files in the vault. When a client leaves, the server waits for {i} seconds and closes the file.") for i in range(30)]
CASES = [
    (1, "What is `a_b`?", None, "empty"),
    (2, "What is `a_b`?", "<p> </p>", "empty"),
    (3, "What is `a_b`?", "n/a", "empty"),
    (4, "What does `a_b` control in the vault?", "You asked: What does `a_b` control in the vault?", "copy"),
    (5, "What does `a_b` control?", "Sorry, the provided text does not mention `a_b`.", "refusal"),
    (6, "Was regelt `a_b`?", "Das kann ich anhand des Textes nicht beantworten.", "refusal"),
    (7, "What does `a_b` control?", "It keeps the old files in the vault. When a client leaves, the", "truncated"),
    (8, "What does `a_b` control?", "It keeps the old files.\n\n```yaml\na: 1\nb:", "truncated"),
    (9, "What does the old setting `a_b` control in the vault?", "El servidor guarda los archivos en el nodo y cierra las copias cuando la red está caída.", "language"),
    (10, "What does `a_b` control?", "Set `a_b` to 16", None),
    (11, "What does `a_b` control?", 'The client prints "Sorry, this request cannot be answered" in that state and keeps the file.', None),
    (12, "What does `a_b` control?", "When a client leaves, the server closes the file", None),
    (13, "What does `a_b` control?", "It keeps the old files.\n\n* `a_b`\n* `c_d`", None),
]


def test_flags(spark):
    df = spark.createDataFrame([c[:3] for c in CASES] + FILL + [CASES[4][:3]], "record_id long, question string, answer string").withColumn("defect", F.lit("x"))
    got = {r["record_id"]: r["defect"] for r in flag_defects(df).collect()}
    assert got == {c[0]: c[3] for c in CASES if c[3]}
    assert flag_defects(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", [None, "", "   ", "​", "—", "[]", "None", "&nbsp;", "..."])
def test_empty(text):
    assert is_empty(text)


def test_parts():
    assert not is_empty("16") and not is_refusal("The server does not answer until the lease ends. It then writes the file.")
    assert is_copy("What does `a_b` do in the vault of Zed?", "WHAT DOES `A_B` DO IN THE VAULT OF ZED") and not is_copy("What does `a_b` do?", "It sorts files.")


def test_nothing_is_too_long(spark):
    no = "Sorry, the given passage does not mention the setting that you asked for."
    assert is_refusal(" ".join([no] * 9)) and is_refusal(no + " " + "Unfortunately I cannot answer that " + "and that " * 60 + "either.")
    assert is_refusal(no + " Please consult the official manual. In general, vendors describe such things elsewhere.")
    assert not is_refusal(" ".join([no] * 9) + " The server keeps it in the vault.")
    assert is_empty("-" * 500) and is_empty("[ " + " " * 300 + "n/a ]") and not is_empty("n/a " * 40)
    q = "What does `a_b` do in the old vault of Zed when the client leaves?"
    assert is_copy(q, " ".join([q] * 7)) and not is_copy(q, " ".join([q] * 7) + " It sorts the files, closes all leases, renames each copy and waits for nine seconds.")


def test_rare_words_stay_known(spark):
    # many words, each seldom: a last word met three times is known whatever else the corpus holds
    base = [(k, "What does `a_b` do?", f"It keeps word{k}x in store{k}y. Then thing{k}z closes.") for k in range(3000)]
    tail = [(9000 + k, "What does `a_b` do?", "The server keeps the seldom zephyr. Then it closes the zephyr.") for k in range(3)]
    asked = [(9100, "What does `a_b` do?", "It closes the zephyr"), (9101, "What does `a_b` do?", "It closes the zep"), (9102, "What does `a_b` do?", "zephyr")]
    df = spark.createDataFrame(base + tail + asked, "record_id long, question string, answer string")
    assert {r["record_id"]: r["defect"] for r in flag_defects(df).collect()} == {9101: "truncated"}
