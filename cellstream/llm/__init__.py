"""Operations of a training-data pipeline over documents and embeddings; nothing outside this folder imports it."""
