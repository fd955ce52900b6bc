"""Reading exports, turning each into fact rows, and the fact table itself."""
