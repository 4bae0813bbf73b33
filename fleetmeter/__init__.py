"""Fleet analytics for connected sensors on Spark: device state, activity, data quality, metrics."""
