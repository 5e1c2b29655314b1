"""End-to-end jobs: the offline job (R1+R2), the area job (R4), the real-time job."""
