"""wagelens: Spark-native socio-economic analytics.

Landed statistical series -> parsed dimensions -> first-row-wins star schema
(prices, wages, employment) -> gold relation of wages, price index and
unemployment -> dashboard summaries, exports and Spark ML models.
"""

__version__ = "0.1.0"
