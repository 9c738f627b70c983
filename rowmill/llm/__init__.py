"""Operations of training-data pipelines: mixing, token files, captures, duplicates, extraction, filters."""
