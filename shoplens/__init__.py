"""shoplens: customer segmentation (RFM, K-means, evidence, audits) as Spark DataFrame jobs."""

__version__ = "0.1.0"
