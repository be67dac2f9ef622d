"""Lake tables, landed payloads and manifests."""
