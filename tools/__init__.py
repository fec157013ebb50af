"""Developer tools (oracle comparison)."""
