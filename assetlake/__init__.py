"""assetlake: a PySpark-native engine that turns a labelled collection of files
into a training-ready dataset (bronze -> silver -> gold) and reports on it.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions; Python runs only inside Arrow-batched ``mapInPandas`` for image
pixels, never per row on the driver.
"""

from assetlake.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
