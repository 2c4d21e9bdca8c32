"""Operations of a training-data pipeline on the ``documents`` family of
tables.  Nothing else in the library imports this package."""
