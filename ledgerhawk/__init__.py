"""ledgerhawk: daily card-transaction warehouse loads (SCD1/SCD2) and a
fraud report, built on Spark DataFrames."""

__version__ = "0.1.0"
