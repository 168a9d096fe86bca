"""salesmart: a Spark-native retail sales mart.

Raw sales records -> cleaned, typed sales (insert-if-absent per key) -> star schema
(stores, items, calendar, transactions) -> features and exact decimal metrics -> run log.
"""

__version__ = "0.1.0"
