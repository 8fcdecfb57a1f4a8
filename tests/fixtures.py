"""Small tables with known results."""

NER17 = [
    ("test_annotation", 0, "B-ORG", "FIELD", "FIELD"),
    ("test_annotation", 1, "I-ORG", "VALUE", "VALUE"),
    ("test_annotation", 2, "I-ORG", "ADDRESS", "ADDRESS"),
    ("realistic_test", 0, "FIELD", "FIELD", "FIELD"),
    ("realistic_test", 1, "VALUE", "VALUE", "VALUE"),
    ("realistic_test", 2, "ADDRESS", "FIELD", "FIELD"),
    ("realistic_test", 3, "B-PER", "B-PER", "B-PER"),
    ("realistic_test", 4, "I-PER", "I-PER", "I-PER"),
    ("realistic_test", 5, "I-PER", "I-PER", "B-PER"),
    ("flat_vs_bio_test", 0, "B-ORG", "ORG", "ORG"),
    ("flat_vs_bio_test", 1, "I-ORG", "ORG", "ORG"),
    ("flat_vs_bio_test", 2, "O", "O", "O"),
    ("flat_vs_bio_test", 3, "B-ORG", "ORG", "ORG"),
    ("flat_vs_bio_test", 4, "I-ORG", "ORG", "ORG"),
    ("flat_vs_bio_test", 5, "I-ORG", "ORG", "ORG"),
    ("flat_vs_bio_test", 6, "B-MONEY", "MONEY", "MONEY"),
    ("flat_vs_bio_test", 7, "I-MONEY", "MONEY", "MONEY"),
]

TRACK6 = [
    (case, page, "", "", "annotator1", "no", "annotator2", "no", "")
    for case, page in [
        ("1-12ABCDEF", "9876543210_01_0"),
        ("1-12ABCDEF", "9876543210_02_0"),
        ("1-15XYZWQP", "1122334455_01_1"),
        ("1-15XYZWQP", "1122334455_03_1"),
        ("1-19R5T7G3", "5566778899_01_0"),
        ("1-19R5T7G3", "5566778899_03_0"),
    ]
]
UPDATES3 = [
    ("1-12ABCDEF", "9876543210_01_0", "annotator1", "yes", 0),
    ("1-15XYZWQP", "1122334455_03_1", None, "yes", 1),
    ("1-19R5T7G3", "5566778899_01_0", "annotator2", "yes", 2),
]


def ner17(spark):
    return spark.createDataFrame(
        NER17, "file string, pos bigint, pred string, annotator1_label string, annotator2_label string"
    )


def track6(spark):
    from pagemark.schemas import ASSIGNMENTS

    return spark.createDataFrame(TRACK6, ASSIGNMENTS)


def updates3(spark):
    return spark.createDataFrame(
        UPDATES3, "case_id string, image_id string, annotator string, status string, ord bigint"
    )
