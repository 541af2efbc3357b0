"""Small scored tables for tests."""


def scored(spark, labels, scores):
    return spark.createDataFrame(
        list(zip(labels, scores, strict=True)), "machine_failure int, probability double"
    )
