"""tidemark: marketing analytics (staging, marts, attribution, data quality,
churn modelling and pipeline metrics) as Spark DataFrame jobs."""

__version__ = "0.1.0"
