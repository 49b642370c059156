"""Texts and table builders shared by the test modules."""

CORPUS = ("seven grey herons waited in the morning mist while the ferry crossed the narrow bay. "
          "a baker on the quay lit his oven, and the waiting crew joked about the extra zeal of the tax office. "
          "the herons waited; the people of the port waited longer. ") * 15


def texts_df(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
