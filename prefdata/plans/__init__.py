"""End-to-end plans: the reference's stages composed from the operators (A-D of SURVEY section 3)."""
