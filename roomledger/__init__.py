"""roomledger: booking analytics on Spark.

Raw reservation records -> typed, quality-labelled silver table -> star schema (five dimensions
and one fact with stable surrogate keys) -> business views, dashboard datasets and data-quality
reports. Every stage is a lazy DataFrame transformation; see README.md for the layout.
"""
