def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
