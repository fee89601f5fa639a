"""The cleansing and scoring rules over a stream of records."""
