"""Rules, schemas and the masking plan built from them."""
