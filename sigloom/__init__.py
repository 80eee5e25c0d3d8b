"""sigloom: multichannel recordings and text corpora as Spark jobs."""
