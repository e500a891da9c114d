"""Training-data operators: mixing, quality, sharding, token counts, near and exact
de-duplication, packing, chat formatting, exact search, language-model scoring,
collocations, conversation tries and repeated strings.

Nothing else in the library imports this subpackage."""
