"""Operations of a training-data pipeline on a corpus of documents."""
