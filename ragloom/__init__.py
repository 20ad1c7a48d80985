"""ragloom — retrieval and conversation analytics as Spark DataFrame jobs.

Entry points, all taking and returning DataFrames (lazy unless noted):

* documents → chunks: `operators.chunk.chunk_fixed`, `chunk_recursive`
* vectors: `operators.vectors.embed_corpus`, `embed_queries`, `embed_with`
* search: `operators.retrieve.knn_sparse`, `knn_dense`, `ivf_index` + `ann_join`
* collection: `plans.collection.collection_rows`, `write`, `search`
* conversations: `operators.sessions.pair_exchanges`, `last_n_exchanges`,
  `exchanges_balanced`, `last_n_exchanges_balanced`
* prompts: `operators.prompts.stuff_context`, `rag_prompt`, `history_query`
* tools and replies: `operators.tools`, `operators.structured`
* files: `sources.files.load_directory`; store: `sources.store`
* end to end: `plans.flows.embed_directory`, `chat_prompts`
* streams: `streaming.history.stream_history`, `streaming.assemble.stream_assemble`,
  `streaming.retrieve.stream_retrieve`, `stream_prompts`, `ingest_stream`

`__spark_entry__.queries()` lists every registered query over the driver tables.
"""
