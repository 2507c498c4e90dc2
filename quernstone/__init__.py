"""quernstone: curation of document text as Spark DataFrame transforms."""
