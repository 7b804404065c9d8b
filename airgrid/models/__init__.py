"""Tree models on the feature table and what is read off them."""
