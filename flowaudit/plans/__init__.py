"""End-to-end compositions and the registered checks of every operator."""
