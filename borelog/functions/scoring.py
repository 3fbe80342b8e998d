"""Any other model as a vectorised SQL function, for the SQL table function ``predict_state``; trees need none, see ``tree_sql``."""

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import SparkSession, types as T

from borelog.schema import MODEL_FEATURES


def register_batch_model(spark: SparkSession, make_predict, name: str = "state_model", batch_size: int = 4096) -> str:
    """Register any model as a SQL function of one array, the features in ``MODEL_FEATURES`` order.

    ``make_predict()`` loads it, once per Python worker, and returns its predict function: a matrix with one row per
    observation in, NaN where there is no reading, an array of state codes out.
    """
    predict = predict_batch_udf(
        make_predict,
        return_type=T.DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[len(MODEL_FEATURES)]],
    )
    spark.udf.register(name, predict)
    return name
